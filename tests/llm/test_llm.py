"""Operators of deq.llm on a small table with every awkward case, against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from deq.llm import common, fingerprints, jaccard, lines, packing, personal, quality, queries, sampling, sharding, substrings, toxicity

SCHEMA = "doc_id long, text string, lang string, h long, c long, u long, _a long, n long"


def made_texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(8):
        words = base[i % 3].split()
        words[rng.randrange(60)] = "changed"
        rows.append((10 + i, " ".join(words)))
    passage = " ".join(rng.choices(vocabulary, k=45))
    for i in range(4):
        rows.append((30 + i, f"{' '.join(rng.choices(vocabulary, k=20))} {passage}\n{' '.join(rng.choices(vocabulary, k=20))}"))
    line = "this very line is long enough to count"
    rows += [(40, f"{line}\nother words here and more of them"), (41, line + "s"), (42, line.replace("very", "vary")), (43, line[1:])]
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, "one two"), (None, base[0]), (None, None), (0, base[0])]
    rows += [(60, "long " * 3000), (61, "x" * 3000), (62, "é 漢字\n\n tab\there  two")]
    rows += [(70, "mail a.b@c.example.org now 10.2.3.4 or 300.1.1.1 card 4539 1488 0343 6467 call +1 (988) 555-2485 end")]
    return rows


ROWS = made_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "en", 1, 2, 3, 4, 5) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def test_jaccard_matches_brute_force(docs, empty):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, 4, 85).collect())
    sets = []
    for _, text in ROWS:
        w = [x.lower() for x in words(text)]
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(ROWS)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ROWS)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(ROWS):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    want = collections.Counter((d, len(sets[i]), least.get(root(i), d)) for i, (d, _) in enumerate(ROWS))
    assert got == want
    assert jaccard.near_duplicates(empty, 4, 85).count() == 0


def test_remembered_word_digests_take_little_memory():
    common.forget_digests()
    tracemalloc.start()
    got = [common.word_digests(b" ".join(b"word%d" % i for i in range(at, at + 10_000))) for at in range(0, 500_000, 10_000)]
    got = np.concatenate(got)
    used = tracemalloc.get_traced_memory()[0] - got.nbytes
    tracemalloc.stop()
    common.forget_digests()
    assert used < 30_000_000
    assert all(got[i] == xxhash.xxh3_64_intdigest(b"word%d" % i) for i in range(0, 500_000, 1009))


def test_spread_shingles_give_the_same_links(docs, monkeypatch):
    want = sorted(map(str, jaccard.near_duplicates(docs, 4, 85).collect()))
    monkeypatch.setattr(jaccard, "HOT_SHARE", 10**9)
    assert sorted(map(str, jaccard.near_duplicates(docs, 4, 85).collect())) == want


def test_one_of_each_keeps_one(docs):
    kept = jaccard.one_of_each(docs, 4, 85).collect()
    assert kept[0].__fields__ == docs.columns
    ids = collections.Counter(r.doc_id for r in kept)
    assert ids[0] == 1 and not any(ids[i] for i in (10, 13, 16))
    assert {50, 51, 52, 53, 60, 62, 70} <= set(ids)


def test_repeated_passages_match_brute_force(docs, empty):
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(docs, 35).collect())
    seen = collections.Counter(tuple(words(t)[i : i + 35]) for _, t in ROWS for i in range(len(words(t)) - 34))
    want = collections.Counter()
    for doc_id, text in ROWS:
        w = words(text)
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        want[doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want
    assert substrings.without_repeats(empty, 35).count() == 0


def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_lines_match_brute_force(docs, empty, spark):
    rng = random.Random(5)
    stem = "abcabcabcabcabcabcabcabc"
    near = []
    for i in range(60):
        s = list(stem)
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(s))
            s[at : at + rng.randint(0, 1)] = rng.choices("abcd", k=rng.randint(0, 1))
        near.append((200 + i, "".join(s)))
    plain = [(d, t) for d, t in ROWS if d is not None and (d, t) != ROWS[0]] + [ROWS[0]] + near
    table = spark.createDataFrame([(*r, "en", 1, 2, 3, 4, 5) for r in plain], SCHEMA)
    got = {r.doc_id: list(r.removed) for r in lines.line_table(table).collect()}
    earlier, want = [], collections.defaultdict(list)
    for doc_id, text in sorted(plain, key=lambda r: r[0]):
        for n, line in lines.long_lines(text, 20):
            if any(within_one(line, o) for o in earlier):
                want[doc_id].append(n)
            earlier.append(line)
    assert got == {d: want[d] for d, _ in plain}
    assert lines.line_table(empty).count() == 0 and lines.without_repeated_lines(empty).count() == 0
    cut = lines.without_repeated_lines(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert lines.without_repeated_lines(docs, drop_emptied=True).filter("doc_id = 41").count() == 0


def test_neighbourhoods_hold_only_what_a_shared_half_leaves_open(spark):
    """Every pair within one edit meets in a wanted variant; lines that share no half in a fitting length want nothing."""
    rng = random.Random(6)
    made = set()
    for _ in range(120):
        s = list(rng.choice(["abababababababababababab", "aaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz", "é漢abcabcabcabcabcabcabc"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(s))
            s[at : at + rng.randint(0, 1)] = rng.choices("abz", k=rng.randint(0, 1))
        made.add("".join(s))
    texts = sorted(made) + ["lone line without any neighbour", "one front half of this and aaaaaaaaaaaaa", "one front half of this and bbbbbbbbbbbbbbbbbb"]
    found = lines._candidates(spark.createDataFrame([(t,) for t in texts], "text string"), 20)
    want = {r.h: r.want for r in found.collect()}
    assert not any(lines.digest(t) in want for t in texts[-3:])
    keys = {t: set(zip(*(x.tolist() for x in lines.variant_keys(t, want.get(lines.digest(t), 0))))) for t in texts}
    for x, y in itertools.combinations(made, 2):
        same = {k for k, r in keys[x] if r == 2} & {k for k, r in keys[y] if r == 2}
        short, longer = sorted((x, y), key=len)
        put_in = {k for k, r in keys[short] if r == 0} & {k for k, r in keys[longer] if r == 1}
        assert bool(same) == (len(x) == len(y) and within_one(x, y)) and bool(put_in) == (len(x) != len(y) and within_one(x, y))
    full = {t: 2 * len(t) + 1 for t in texts}
    assert sum(map(len, keys.values())) < 0.8 * sum(full.values())


def test_short_lines_go_when_they_are_repeated(spark):
    long = "this very line is long enough to count"
    rows = [(1, f"Short one.\n{long}\n- b\n\n- b"), (2, f" Short one. \n{long}"), (3, "Short one\n\n \n- c\nown"), (4, "- c")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: list(r.removed) for r in lines.line_table(table).collect()}
    assert got == {1: [4], 2: [0, 1], 3: [], 4: [0]}
    left = {r.doc_id: r.text for r in lines.without_repeated_lines(table, drop_emptied=True).collect()}
    assert left == {1: f"Short one.\n{long}\n- b\n", 3: rows[2][1]}


def test_quality_matches_sql_and_order_does_not_matter(docs, empty):
    con = duckdb.connect()
    frame = docs.select("doc_id", "text").toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT doc_id, text FROM frame")
    sql = collections.Counter(con.execute(queries.ORACLES["op3_quality_cascade"]).fetchall())
    got = quality.quality_table(docs)
    assert collections.Counter(tuple(r) for r in got.collect()) == sql
    assert quality.quality_table(empty).count() == 0
    order = docs.select(quality.rejected(docs["text"], quality.RULES).alias("x")).collect()
    assert order == docs.select(quality.rejected(docs["text"], quality.RULES[::-1]).alias("x")).collect()
    assert quality.quality_filter(docs).columns == docs.columns


def test_quality_filter_takes_customary_cuts(spark):
    rng = random.Random(9)
    plain = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(4, 7))) for _ in range(60)) for _ in range(8)]
    runs = " ".join(f"{w} {w}" for w in plain[5].split())
    parts = [" ".join(plain[2].split()[i : i + 8]) for i in range(0, 56, 8)]
    mixed = "\n".join([f"{x}\nsee more" for x in parts[:5]] + parts[5:])
    rows = [(1, plain[0]), (2, plain[1].replace(" ", " | ", 20)), (3, runs), (4, mixed)]
    rows += [(5, " ".join(w[:2] for w in plain[6].split())), (6, " ".join(w + "ijklmnop" for w in plain[7].split()))]
    rows += [(7, plain[1].replace(" ", " | ", 4))]
    kept = quality.quality_filter(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {1, 7}


def plain_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        out += [(1, m.start(), m.end())] if all(int(x) <= 255 for x in m.group().split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        out += [(2, m.start(), m.end())] if 13 <= len(d) <= 19 and personal.luhn(d) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        out += [(3, m.start(), m.end())] if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15 else []
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choices("0123456789..@@ab- +()1", k=rng.randint(0, 60)))
        assert personal.base_spans(t) == plain_spans(t)


def test_counts_and_digests_of_kinds_match_the_patterns(spark):
    rng = random.Random(8)
    parts = ["a@b.co", "10.2.3.4", "256.1.1.1", "4539 1488 0343 6467", "4539148803436467", "+1 (988) 555-2485", "é", " ", ", ", "word", "@", "1"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    rows += [(None, "x 10.2.3.4"), (None, None), (300, None), (301, ""), (302, "a@b.co c@d.org"), (302, "a@b.co c@d.org"), (302, "10.2.3.4")]
    want = []
    for i, text in rows:
        spans = plain_spans(text or "")
        written = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        counts = [sum(k == n for k, _, _ in spans) for n in range(4)]
        want.append((i, *counts, hashlib.sha256(written.encode()).hexdigest()))
    table = personal.personal_table(spark.createDataFrame(rows, "doc_id long, text string"))
    got = table.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_contexts_find_unseen_identifiers(spark, docs, empty):
    def number(i):
        stem = f"4539{i:011d}"
        return next(stem + str(c) for c in range(10) if personal.luhn(stem + str(c)))

    rows = [(i, f"some words account number {number(i * 37)} and so on") for i in range(30)]
    bad = number(999)[:-1] + str((int(number(999)[-1]) + 1) % 10)
    rows.append((100, f"some words account number {bad} and so on"))
    table = personal.personal_table(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in table.collect()}
    assert found[100].n_card == 0 and found[100].n_discovered == 1 and found[100].spans == "card:26:42"
    assert sum(r.n_discovered for r in found.values()) == 1
    assert personal.personal_table(empty).count() == 0
    clean = {r.doc_id: r.text for r in personal.redact(docs).collect()}
    assert clean[70] == "mail [EMAIL] now [IP] or 300.1.1.1 card [CARD] call [PHONE] end"
    assert clean[50] is None and personal.redact(docs).count() == len(ROWS)


def test_discovered_identifiers_support_further_contexts(spark):
    def number(i, good):
        stem = f"4539{i:011d}"
        return next(stem + str(c) for c in range(10) if personal.luhn(stem + str(c)) == good)

    bad = [number(1000 + i, False) for i in range(40)]
    rows = [(i, f"some words account number {number(i * 37, True)} and so on") for i in range(60)]
    rows += [(100 + i, f"some words account number {v} and so on") for i, v in enumerate(bad[:4])]
    rows += [(200 + i, f"it was charged to {v} again") for i, v in enumerate([*bad[:4], bad[10]])]
    rows += [(300 + i, f"never seen under {v} here") for i, v in enumerate(bad[20:])]
    table = personal.personal_table(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in table.collect() if r.n_discovered}
    assert set(found) == {100, 101, 102, 103, 200, 201, 202, 203, 204}
    assert found[204] == "card:18:34"


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_ring_fills_evenly(docs, empty, shards):
    rows = sharding.ring_shards(docs, shards).collect()
    sizes = collections.Counter(r.shard for r in rows)
    assert len(rows) == len(ROWS) and max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    assert sharding.ring_shards(empty, shards).count() == 0


def test_more_shards_change_only_the_cells_they_take():
    before, after = sharding.ring_owners(8), sharding.ring_owners(9)
    assert all(a == b or b == 8 for a, b in zip(before, after))


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(50):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        plan = packing.best_fit_plan(collections.Counter(lengths), capacity)
        bins = collections.defaultdict(list)
        for length, lo, hi, first, per, offset in plan:
            for r in range(hi - lo):
                bins[first + r // per].append((offset + r % per * length, length))
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
            if fits:
                rooms[min(fits)[1]] -= n
            else:
                rooms.append(capacity - n)
        assert sorted(capacity - sum(n for _, n in b) for b in bins.values()) == sorted(rooms)
        for b in bins.values():
            at = 0
            for offset, n in sorted(b):
                assert offset == at
                at += n


def test_pieces_are_the_tokenizers_ids(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    rows = packing.best_fit_pack(packing.token_pieces(docs, path, 512), 512).collect()
    want = collections.Counter()
    for doc_id, text in ROWS:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = np.asarray(ids[at : at + 512], "<u4")
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.best_fit_pack(packing.token_pieces(empty, path)).count() == 0


def test_sketches(docs, empty, spark):
    table = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in fingerprints.fingerprint_table(table).collect()}
    order = sorted(((r.doc_id, r.text or "") for r in table.collect()), reverse=True)
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert rows[doc_id].n_chars == len(text) and 0 <= rows[doc_id].near_edited <= 1
    assert fingerprints.fingerprint_table(docs).count() == len(ROWS)
    assert fingerprints.fingerprint_table(empty).count() == 0
    single = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert fingerprints.fingerprint_table(single).first().near_next == 1.0


def test_sampled_segmentations_follow_the_lattice(docs, empty):
    np.seterr(over="ignore")
    lattice = sampling.load(queries.tokenizer_path("piece_bpe_32k.model"), 1.0)
    n = 20000
    found = sampling.sample(lattice, ["hello é"] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919), 2)
    p = {tuple(x[0]): math.exp(x[1]) for f in found for x in f}
    first = collections.Counter(tuple(f[0][0]) for f in found)
    both = collections.Counter((tuple(f[0][0]), tuple(f[1][0])) for f in found)
    for a, k in first.most_common(4):
        assert abs(k / n - p[a]) < 0.015
    for (a, b), k in both.most_common(4):
        assert a != b and abs(k / n - p[a] * p[b] / (1 - p[a])) < 0.015
    # Inverse inclusion probabilities estimate the number of the whole, 1.
    assert abs(sum(math.exp(x[1] - x[3]) for f in found for x in f) / n - 1) < 0.03
    path = queries.tokenizer_path("piece_bpe_32k.model")
    rows = sampling.sampled_segmentations(docs, path, 3, with_ids=True)
    assert rows.filter("not round_trip").count() == 0 and rows.select("doc_id").distinct().count() == len({d for d, _ in ROWS})
    texts = {d: t or "" for d, t in ROWS if d is not None}
    for r in sampling.decode(rows, path).filter("doc_id is not null").collect():
        assert r.text == texts[r.doc_id]
    assert sampling.sampled_segmentations(empty, path).count() == 0


def test_toxicity_on_held_out_rows(spark, empty):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.toxicity(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    hits = [r for r in scored if r.predicted]
    assert sum(r.toxic for r in hits) >= 0.9 * len(hits)
    assert sum(r.toxic for r in hits) >= 0.5 * sum(r.toxic for r in scored)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(empty, none).count() == 0
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(docs.limit(5), none).collect())


def test_pipeline_stages_take_awkward_rows(spark, docs, empty):
    import corpus_pipeline

    for start in (docs, empty):
        rows = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, "")
            assert rows.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, "").count() >= rows.count()
