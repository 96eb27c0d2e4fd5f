"""Prefix tries, the dataset manifest and fingerprints against brute force, and their defined edge cases."""

import hashlib
import random
import zlib

import duckdb
import pytest
import xxhash

from cohortwise.llm import links, merkle, order, simhash, trie
from cohortwise.llm.oracles import ORACLES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, at long, n long, node string, grp string, fp long, key string"
TURNS = "conv_id long, turn long, role string, text string, at long, n long, h int, key string"


def documents(spark, rows):
    """Documents (doc_id, text, lang) with columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), 1, 2, "x", "y", 3, "z") for i, t, g in rows], DOCS)


def same_as_sql(spark, found, name, table, given, path):
    given.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in found.select(*columns).collect()) == want
    return len(want)


# --- places


def test_places_of_a_hot_group_with_ties_and_nulls(spark, tmp_path):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.8 else f"g{rnd.randrange(5)}", rnd.choice([None, 1, 2, 3, rnd.randrange(10**6)])) for _ in range(3000)]
    spark.createDataFrame(rows, "g string, v long").write.parquet(f"{tmp_path}/rows")
    found = order.ranked(spark.read.parquet(f"{tmp_path}/rows"), "g", ["v"], cell_rows=100).collect()
    for group in {g for g, _ in rows}:
        own = sorted((r["at"], r["v"]) for r in found if r["g"] == group)
        assert [a for a, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted((v for g, v in rows if g == group), key=lambda v: (v is not None, v or 0))
        assert {r["n"] for r in found if r["g"] == group} == {len(own)}


# --- links


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 300)] + [(500 + i, 500 + (i + 1) % 9) for i in range(9)]
    pairs += [(-(10**15) * rnd.randrange(1, 40), 10**15 * rnd.randrange(1, 40)) for _ in range(30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    rnd.shuffle(pairs)
    found = links.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["id"]: r["root"] for r in found} == {x: root(x) for x in parent}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- fingerprints


def plain_fingerprint(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


@pytest.fixture(scope="module")
def similar_texts():
    rnd = random.Random(5)
    base = [f"word{rnd.randrange(300)}" for _ in range(200)]
    texts = [None, "", "  \n ", "one", "One Two", "one two", "ÄÖ two three", "A\x1cb c\x85d e f", "x " * 5000]
    for _ in range(120):  # a family around one text: chains of nearly equal fingerprints
        own = list(base)
        for _ in range(rnd.randrange(4)):
            own[rnd.randrange(200)] = f"word{rnd.randrange(300)}"
        texts.append(" ".join(own))
    return texts + texts[9:14] + [" ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(40))) for _ in range(40)]


def test_fingerprints_and_components_equal_brute_force(spark, similar_texts, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE_BYTES", 100)
    docs = documents(spark, [(i, t, "en") for i, t in enumerate(similar_texts)])
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for t in similar_texts]
    assert [int(found[i]["fingerprint"], 16) for i in range(len(prints))] == prints
    assert all(len(r["fingerprint"]) == 16 for r in found.values())
    root = list(range(len(prints)))
    for _ in prints:
        before = list(root)
        for i, a in enumerate(prints):
            root[i] = min(root[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 2)
        if root == before:
            break
    assert [found[i]["component_id"] for i in range(len(prints))] == root
    assert len({r["component_id"] for r in found.values()}) < len(prints) - 50


def test_fingerprints_at_every_small_distance(spark):
    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1]
    pairs = [(a, a ^ (1 << i) ^ (1 << j)) for a in base for i, j in ([rnd.sample(range(64), 2) for _ in range(6)] + [[0, 63], [31, 32], [5, 5]])]
    signed = sorted({x - 2**64 * (x >> 63) for p in pairs for x in p})
    members = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r["id"]: r["root"] for r in links.components(simhash.verified(simhash.table_matches(members))).collect()}
    for a, b in pairs:
        a, b = (x - 2**64 * (x >> 63) for x in (a, b))
        assert found.get(a, a) == found.get(b, b)


def test_entries_have_few_holders_whatever_the_family(spark):
    members = spark.createDataFrame([(x,) for x in range(1 << 12)], "fp long")  # all within twelve bits
    held = members.selectExpr("fp").select("fp", simhash.F.explode(simhash.entries(simhash.F.col("fp"))).alias("key"))
    assert max(r["count"] for r in held.groupBy("key").count().collect()) <= 65
    assert simhash.table_matches(members).count() <= 65 * (1 << 12)


def test_fingerprints_of_null_and_repeated_ids_and_no_rows(spark):
    rows = simhash.near_duplicates(documents(spark, [(None, "a b c d", "en"), (None, "", None), (7, "a b c d", "en"), (7, None, "en"), (7, None, "en")])).collect()
    assert sorted((r["fingerprint"] == "0" * 16, r["component_id"]) for r in rows) == [(False, 7)] * 2 + [(True, 7)] * 3
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


# --- manifest


def test_manifest_equals_sql_on_odd_rows(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, f"Text {i} " * rnd.randrange(4), "hot" if i % 5 else f"l{i % 35}") for i in range(1500)]
    rows += [(5000, None, None), (None, "a", "x"), (None, "B", "x"), (7, "Text again", "hot"), (9001, "Ü" * 9, "Ü"), (9002, "", ""), (9003, "x" * 50_000, "a")]
    docs = documents(spark, rows)
    assert same_as_sql(spark, merkle.verify_documents(docs), "op12_manifest", "documents", docs, f"{tmp_path}/docs") == len(rows)


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 512, 513])
def test_roots_at_the_edges_of_runs_and_blocks(spark, size):
    rows = merkle.verify_documents(documents(spark, [(i, "t", "en") for i in range(size)])).collect()
    level = [r["leaf"] for r in sorted(rows, key=lambda r: r["doc_id"])]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + 8]).encode()).hexdigest() for i in range(0, len(level), 8)]
    assert {r["root"] for r in rows} == {r["subroot"] for r in rows} == set(level)
    assert all(r["verified"] for r in rows)  # nothing to lower


def test_repeated_rows_and_no_rows_in_a_manifest(spark):
    rows = merkle.verify_documents(documents(spark, [(1, "SAME", "en")] * 700)).collect()
    assert len(rows) == 700 and len({r["leaf"] for r in rows}) == 1
    assert {r["verified"] for r in rows} == {zlib.crc32(b"1") % 3 != 0}
    assert merkle.verify_documents(documents(spark, [])).count() == 0


# --- tries


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "k") for r in rows], TURNS)


def odd_conversations():
    rnd = random.Random(4)
    rows = []
    for c in range(140):
        if c % 20 == 0 and c % 40:
            continue  # a group without its first conversation
        for t in range(rnd.randrange(1, 7)):
            rows.append((c, t, rnd.choice(["user", "bot", None]), f"turn {rnd.randrange(3)} of few"))
    rows += [(201, t, "user", f"long {t // 2 * 2}") for t in range(41)] + [(202, t, "user", f"long {t // 2 * 2}") for t in range(37)]
    rows += [(203 + k, t, "user", f"long {t // 2 * 2}") for k in range(12) for t in range(20 + k)]
    rows += [(300, None, "user", "null turn"), (300, 1, None, None), (300, 1, "", ""), (-7, 0, "user", "below zero"), (None, 0, "user", "nobody")]
    return rows + [(301, 0, "user", "again")] * 3


@pytest.mark.parametrize(("segment", "shard"), [(128, 20_000), (2, 4), (3, 50), (128, 6), (1, 3)])
def test_tries_equal_sql_on_odd_conversations(spark, tmp_path, monkeypatch, segment, shard):
    monkeypatch.setattr(trie, "SEGMENT_TURNS", segment)
    monkeypatch.setattr(trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(trie, "PIECE_IDS", 2)
    given = conversations(spark, odd_conversations())
    assert same_as_sql(spark, trie.prefix_nodes(given), "op11_prefix_trie", "conversations", given, f"{tmp_path}/turns") > 200


def test_double_arrays_hold_exactly_their_sequences():
    rnd = random.Random(6)
    sequences = sorted({tuple(rnd.randrange(1, 60) for _ in range(rnd.randrange(1, 6))) for _ in range(400)})
    packed = trie.DoubleArray([list(s) for s in sequences])
    prefixes = {s[:d] for s in sequences for d in range(1, len(s) + 1)}
    slots = {p: list(packed.walk(list(p))) for p in prefixes}
    assert all(len(path) == len(p) for p, path in slots.items())
    assert len({path[-1] for path in slots.values()}) == len(prefixes) == len(packed.slots)
    for _ in range(500):
        other = tuple(rnd.randrange(1, 60) for _ in range(4))
        assert len(list(packed.walk(list(other)))) == max(d for d in range(5) if not d or other[:d] in prefixes)


def test_no_conversations(spark):
    assert trie.prefix_nodes(conversations(spark, [])).count() == 0
    assert trie.prefix_nodes(conversations(spark, [(None, 0, "user", "x")])).count() == 0
