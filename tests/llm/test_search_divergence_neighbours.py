"""Ranked search, source divergence and neighbour packing against SQL, brute force and the tokenizer."""

import collections
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from deq.llm import divergence, lexical, neighbours, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score long, rank long, term string, _first long, bucket long"


def made_rows():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for i in range(220):
        text = "".join(w.title() if rng.random() < 0.2 else w + rng.choice([" ", ", ", "\n", "-", "  "]) for w in rng.choices(words, k=rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "en", "de"]), rng.choice(["s1", "s1", "s2", "s3"])))
    rows += [(500, None, "en", "s1"), (501, "", "en", "s4"), (502, " \n.", "fr", "s1"), (503, "Ab12 ab12 AB\x00cd ÉÉ éé 漢字", None, None)]
    rows += [(504, "x" * 5000, "", "s2"), (505, "ab " * 5000, "en", "s2"), (None, rows[0][1], "en", "s1"), (None, None, None, "s1")]
    return rows + [rows[0], rows[0], (506, rows[1][1], "de", "s3")]


ROWS = made_rows()
ITEMS = [(1, ROWS[3][1]), (2, "ab Ab AB cd-ab12"), (3, ""), (4, None), (2, "漢字 éé"), (2, "漢字 éé"), (None, ROWS[5][1]), (7, "nowhere"), (8, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, 2, 3, "t", 4, 5) for r in ROWS], DOCS)


def by_sql(name):
    con = duckdb.connect()
    columns = list(zip(*ROWS))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
    con.register("documents", pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text", "lang", "source"]))
    con.register("benchmark", pa.table([pa.array([i[0] for i in ITEMS], pa.int64()), pa.array([i[1] for i in ITEMS])], ["item_id", "text"]))
    return collections.Counter(con.execute(queries.ORACLES[name]).fetchall())


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 40])
def test_search_matches_sql(spark, docs, monkeypatch, block_bytes):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lexical, "HELD", 50)
    items = spark.createDataFrame([(*i, 0, 0) for i in ITEMS], "item_id long, text string, score long, doc_id long")
    found = lexical.ranked_search(docs, items, 20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, found.collect())) == by_sql("op11_automaton_search")


def test_search_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "ab")], "item_id long, text string")
    assert lexical.ranked_search(docs, none).count() == 0
    assert lexical.ranked_search(docs.limit(0), some).count() == 0


def test_scanner_respects_term_boundaries():
    scanner = lexical.TermScanner([b"ab", b"abc", b"c", "é".encode()])
    assert scanner.counts("ab abc xab AB,ab c-c é éc".encode()) == {0: 3, 1: 1, 2: 2, 3: 1}
    assert lexical.n_terms("ab  é,c".encode()) == 3 and lexical.n_terms(b"") == 0 and lexical.n_terms(b" .") == 0


def test_large_scores_are_summed_exactly():
    cell, value = np.array([0, 1, 0]), np.array([2**52 + 1, 7, 2**52 + 2])
    assert lexical._sums(cell, value, 2, 3).tolist() == [2**53 + 3, 7]


@pytest.mark.parametrize("group_rows", [divergence.GROUP_ROWS, 10])
def test_divergence_matches_sql(docs, monkeypatch, group_rows):
    monkeypatch.setattr(divergence, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(divergence, "CELLS", 30)
    monkeypatch.setattr(divergence, "FAN_IN", 2)
    monkeypatch.setattr(divergence, "COUNTED", 40)
    found = divergence.source_divergence(docs, 30, 50)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = by_sql("op12_skyband_divergence")
    assert collections.Counter(map(tuple, found.collect())) == want
    assert {r[2] for r in want} == {"pair", "term"}
    assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(1)
    for k in (1, 3):
        n = 120
        c, lc, place = rng.integers(0, 8, n), rng.integers(0, 8, n), rng.permutation(n)
        dominated = [sum((c >= c[i]) & (lc <= lc[i]) & (place < place[i])) for i in range(n)]
        assert sorted(divergence.skyband(c, lc, place, k)) == [i for i in range(n) if dominated[i] < k]


def test_shares_are_exact():
    counts = np.array([0, 1, 10**12, 3 * 10**14])
    assert divergence.shares(counts, 4 * 10**14, 10**9).tolist() == [
        1 + 10**9 * (int(c) + 5) // (4 * 10**14 + 5 * 10**9) for c in counts
    ]


@pytest.fixture(scope="module")
def byte_path():
    return queries.tokenizer_path("byte_bpe_50k.json")


def test_fast_ids_are_those_of_the_tokenizer(byte_path):
    own, rng = neighbours.ByteEncoder(byte_path), random.Random(2)
    assert own.fast is not None
    alphabet = [*"ab cd  \n\t\r\x0b\x1c\x85\xa0 é漢😀'strevelmd123,.!-_#<|>\x00", "<|endoftext|>", "'ll", "́"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        assert own.ids(text).tolist() == own.slow.encode(text, add_special_tokens=False).ids


def test_neighbour_packing_holds_every_token_once(spark, docs, byte_path, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 50)
    rows = neighbours.neighbour_pack(docs, byte_path, 64).collect()
    own = neighbours.ByteEncoder(byte_path)
    want = collections.Counter()
    for doc_id, text, *_ in ROWS:
        ids = [*own.slow.encode(text or "", add_special_tokens=False).ids, 0]
        want[doc_id, len(ids)] += 1
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in ROWS:
        if sum(n for (d, _), n in want.items() if d == doc_id) > 1:
            continue
        ids, at = np.array([*own.slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in rows) == sum(n * times for (_, n), times in want.items())
    for own in sequences.values():
        total = 0
        for offset, length in sorted(own):
            assert offset == total
            total += length
        assert total <= 64 and total & (total - 1) == 0
    assert neighbours.neighbour_pack(docs.limit(0), byte_path, 64).count() == 0


def test_shard_scores_match_brute_force_and_seeds_meet_their_like():
    rng = np.random.default_rng(3)
    topics = [rng.choice(1000, 40, replace=False) for _ in range(4)]
    texts = [rng.choice(topics[i % 4], 10) for i in range(32)]
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=1000)
    idf, mean = np.log1p((32 - df + 0.5) / (df + 0.5)), 10.0
    scores = neighbours.ShardIndex(texts, idf, mean).scores(5)
    for i, text in enumerate(texts):
        want = sum(
            idf[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(text) / mean))
            for t, c in collections.Counter(text.tolist()).items()
            if t in texts[5]
        )
        assert scores[i] == pytest.approx(want)
    sequences = neighbours.packed_shard(texts, idf, mean, 40)
    alike = [len({t % 4 for t, _, _ in s}) for s in sequences]
    assert len(sequences) == 8 and all(n == 1 for n in alike[:4])
