"""The sampler beside all segmentations of short texts, enumerated from the vocabulary itself."""

import collections
import math

import numpy as np
import pytest
import sentencepiece

from deq.llm import queries, sampling


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path("piece_bpe_32k.model")


def all_segmentations(path, text):
    """Weight of every way to cut the text into pieces; characters without a piece are bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    known = {model.id_to_piece(i): i for i in plain}
    weight = {i: 1 / (min(-model.get_score(i), size) + 1) for i in known.values()}

    def ways(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            piece = known.get(rest[:n])
            if piece is not None:
                for ids, w in ways(rest[n:]):
                    yield (piece, *ids), w * weight[piece]
            elif n == 1:
                data = rest[0].encode()
                ids_of = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in data)
                for ids, w in ways(rest[1:]):
                    yield (*ids_of, *ids), w * (size + 1.0) ** -len(data)

    found = dict(ways("▁" + text.replace(" ", "▁")))
    total = sum(found.values())
    return {ids: w / total for ids, w in found.items()}


def ids_of(lattice, arcs):
    return tuple(i for t in lattice.token[arcs].tolist() for i in lattice.tokens[t])


@pytest.mark.parametrize("text", ["the cat", "it's 10²", " a  b ", "no\nway", "x_y, zé", "漢 go!!", "end.\tThe"])
def test_all_segmentations_are_found_with_their_probability(path, text):
    np.seterr(over="ignore")
    lattice = sampling.load(path, 1.0)
    exact = all_segmentations(path, text)
    (found,) = sampling.sample(lattice, [text], np.array([5], np.uint64), len(exact) + 3)
    got = {ids_of(lattice, arcs): math.exp(logp) for arcs, logp, *_ in found}
    assert len(found) == len(got) and got.keys() == exact.keys()
    assert all(abs(got[ids] - p) <= 1e-9 * max(p, 1e-300) + 1e-12 for ids, p in exact.items())
    scores = [score for _, _, score, _ in found]
    assert scores == sorted(scores, reverse=True)
    assert all(inclusion == 0 for *_, inclusion in found)


def test_three_of_all_come_without_replacement_in_proportion(path):
    np.seterr(over="ignore")
    lattice = sampling.load(path, 1.0)
    exact = all_segmentations(path, "so it")
    n = 30000
    found = sampling.sample(lattice, ["so it"] * n, np.arange(n, dtype=np.uint64) * np.uint64(104729), 3)
    drawn = collections.Counter(tuple(ids_of(lattice, arcs) for arcs, *_ in f) for f in found)
    assert all(len(set(order)) == 3 for order in drawn)
    for (a, b, c), times in drawn.most_common(8):
        p = exact[a] * exact[b] / (1 - exact[a]) * exact[c] / (1 - exact[a] - exact[b])
        assert abs(times / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_samples_do_not_depend_on_what_was_sampled_before(path):
    np.seterr(over="ignore")
    texts = ["some words, 12 of them", "", "other  words\n", "some words, 12 of them", "y" * 3000]
    seeds = np.arange(1, 6, dtype=np.uint64)
    fresh = sampling.Lattice(path, 1.0)
    alone = [[(ids_of(fresh, r[0]), *r[1:]) for r in sampling.sample(fresh, [t], s, 2)[0]] for t, s in zip(texts, seeds[:, None])]
    warm = sampling.load(path, 1.0)
    sampling.sample(warm, ["words of other texts come first"] * 20, np.arange(20, dtype=np.uint64), 2)
    together = [[(ids_of(warm, r[0]), *r[1:]) for r in rows] for rows in sampling.sample(warm, texts, seeds, 2)]
    assert alone == together
