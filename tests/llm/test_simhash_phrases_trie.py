"""SimHash near-duplicates, phrase collocations and the conversation trie against brute force and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lakeload.llm import collocations, prefix_trie, queries, simhash
from lakeload.llm import quotient_filter as qf

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega".split()
DOCS = "doc_id long, text string, lang string, source string, id long, fp string, key string, n long, word string, chunk string, place long"


def _low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _wide(rows):
    return [(i, t, lang, None, 1, "x", "y", 2, "z", "c", 3) for i, t, lang in rows]


def _fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", _low(t))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(prints):
    par = list(range(len(prints)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = root(a), root(b)
            par[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def test_simhash_against_brute_force(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "one two", "ONE\ttwo", "a b c", "é中 — ½ ö", "x " * 3000, "y" * 100_000]
    for _ in range(12):
        base = [r.choice(WORDS) for _ in range(r.randint(60, 400))]
        texts += ["  \n".join(w if r.random() > 0.004 else r.choice(WORDS) for w in base) for _ in range(r.randint(1, 6))]
    docs = spark.createDataFrame(_wide([(i, t, "en") for i, t in enumerate(texts)]), DOCS)
    got = {x["doc_id"]: (x["fp"] & (1 << 64) - 1, x["component_id"]) for x in simhash.simhash_classes(docs).collect()}
    prints = [_fingerprint(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == prints
    assert [got[i][1] for i in range(len(texts))] == _classes(prints)
    assert len(set(_classes(prints))) < len(set(prints))  # some links join unlike fingerprints


def test_simhash_text_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 50)
    t = " ".join(random.Random(5).choice(WORDS) for _ in range(700))
    assert simhash.fingerprint(t.encode()) == _fingerprint(t)


@pytest.mark.parametrize("posting", [2, 32])
def test_simhash_links_in_long_and_short_lists(spark, monkeypatch, posting):
    """Clusters far above the pairing bound, chains, bit 63, and lone fingerprints: the components of all pairs."""
    monkeypatch.setattr(simhash, "POSTING", posting)
    r = random.Random(posting)
    prints = [0, 1, 3, 7, 1 << 63, 3 << 62]
    for _ in range(4):
        centre = r.getrandbits(64)
        for _ in range(90):
            x = centre
            for b in r.sample(range(64), r.randint(0, 4)):
                x ^= 1 << b
            prints.append(x)
    prints = sorted(set(prints + [r.getrandbits(64) for _ in range(100)]))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    at = {x: i for i, x in enumerate(signed)}
    par = list(range(len(prints)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    for x in found:
        a, b = at[x["a"]], at[x["b"]]
        assert (prints[a] ^ prints[b]).bit_count() <= 2
        x, y = root(a), root(b)
        par[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(prints))] == _classes(prints)


def test_simhash_cases(spark):
    rows = [(None, "a b c d", "en"), (7, "a b c d", "en"), (7, "a b c d", "en"), (9, None, "en"), (8, "", "en"), (None, "lone text of its own", "en")]
    out = simhash.simhash_classes(spark.createDataFrame(_wide(rows), DOCS)).collect()
    assert sorted((x["doc_id"], x["component_id"]) for x in out if x["doc_id"] is not None) == [(7, 7), (7, 7), (8, 8), (9, 8)]
    assert sorted(str(x["component_id"]) for x in out if x["doc_id"] is None) == ["7", "None"]
    assert simhash.simhash_classes(spark.createDataFrame([], DOCS)).collect() == []
    named = spark.createDataFrame([("b", "a b c d"), ("a", "a b c d")], "doc_id string, text string")
    assert {x["component_id"] for x in simhash.simhash_classes(named).collect()} == {"a"}


@pytest.mark.parametrize("bits", [1, 7, 21, 22, 42])
def test_quotient_filter_is_lossless(bits):
    r = np.random.default_rng(bits)
    top = (1 << bits) - 1
    a, b, c = (r.integers(0, top, 5000, endpoint=True) for _ in range(3))
    a[:700], b[:700], c[:700] = 1, 1, 0  # a counter above one byte
    h = qf.half_bits(bits)
    hi, lo = qf.pack(a, b, c, bits)
    assert [x.tolist() for x in qf.unpack(hi, lo, bits)] == [a.tolist(), b.tolist(), c.tolist()]
    p = qf.permute(hi, lo, h)
    assert [x.tolist() for x in qf.unpermute(*p, h)] == [hi.tolist(), lo.tolist()]
    want = Counter(zip(a.tolist(), b.tolist(), c.tolist()))
    for block_bits in (0, min(3, h)):
        shards = defaultdict(list)
        for cut in np.array_split(np.arange(5000), 3):
            for block, n, blob in qf.split(*qf.tally(p[0][cut], p[1][cut], None, h), h, block_bits):
                assert n == len(qf.load(blob, h, block_bits)[0])
                shards[block].append(blob)
        got = Counter()
        for blobs in shards.values():
            mhi, mlo, n = qf.merged(blobs, h, block_bits)
            for key, k in zip(zip(*(x.tolist() for x in qf.unpack(*qf.unpermute(mhi, mlo, h), bits))), n.tolist()):
                got[key] += k
        assert got == want


def _phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _low(t)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang or "und"] += len(w)
            for m in (1, 2, 3):
                counts[lang or "und"].update(w[i : i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if len(p) == 2 and any(len(x) == 3 and p in (x[:2], x[1:]) and 100 * b >= 50 * a for x, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("entries", [64, 1 << 20])
def test_collocations_against_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(collocations, "BLOCK_ENTRIES", entries)
    r = random.Random(entries)
    few = WORDS[:7] + ["é中", "ö½"]
    rows = [(i, "".join(r.choice(few) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r", " A "]) for _ in range(r.randint(1, 60))), r.choice(["en", "de", None, "und"])) for i in range(120)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \t.,\n", "fr"), (203, "solo " * 500, "xx"), (204, "w" * 50_000, "xx"), rows[0], rows[0]]
    docs = spark.createDataFrame(_wide(rows), DOCS).repartition(5)
    for top in (5, 2000):
        got = collocations.collocations(docs, top=top).collect()
        cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(tuple(x[c] for c in cols) for x in got) == _phrases(rows, 10, top)
    assert got


def test_collocations_rows_and_batches_stay_small(spark, monkeypatch):
    """No row holds a whole chunk, whatever a partition has, and texts come in batches of few rows."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def spy(df, name, stage=collocations.stage):
        seen.append((name, out := stage(df, name), spark.conf.get(key)))
        return out

    monkeypatch.setattr(collocations, "stage", spy)
    before, r = spark.conf.get(key), random.Random(8)
    rows = [(i, " ".join(r.choice(WORDS[:9]) for _ in range(4000)), "en") for i in range(40)]
    got = collocations.collocations(spark.createDataFrame(_wide(rows), DOCS).coalesce(1)).collect()
    assert sorted(tuple(x) for x in got) == _phrases(rows, 10, 2000)
    (table, batch), *_ = [(t, n) for name, t, n in seen if name == "phrase-chunks"]
    assert {f.dataType.typeName() for f in table.schema} <= {"long", "integer", "string", "binary"}
    runs = [x for x in table.collect() if x["tokens"] is not None]
    most = collocations.RUN_TOKENS
    assert sorted(x["n"] for x in runs) == [160_000 - 2 * most, most, most] and len({x["chunk"] for x in runs}) == 1
    assert int(batch) == 1000 and spark.conf.get(key) == before


@pytest.mark.parametrize("held", [300, 1 << 20])
def test_collocations_chunks_fill_across_batches(monkeypatch, held):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 100)
    monkeypatch.setattr(collocations, "HELD_BYTES", held)
    r = random.Random(held)
    rows = [(r.choice(["en", "de", "fr"]), b"%d " % i * r.randint(1, 9)) for i in range(300)] + [("en", b"x" * 5000)] + [(f"l{i}", b"once") for i in range(40)]
    batches = [pa.RecordBatch.from_pydict({"lang": [x[0] for x in rows[i : i + 3]], "text": pa.array([x[1] for x in rows[i : i + 3]], pa.binary())}) for i in range(0, len(rows), 3)]
    got, sizes = defaultdict(list), defaultdict(list)
    for lang, data, offsets in collocations._texts(iter(batches)):
        got[lang] += [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
        sizes[lang].append(len(data))
    want = defaultdict(list)
    for lang, t in rows:
        want[lang].append(t)
    assert got == want
    assert all(n <= 100 or n == 5000 for x in sizes.values() for n in x)
    if held > 300:
        assert min(sizes["de"][:-1]) > 50


def test_collocations_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame(_wide([(1, "rare words only", "en")]), DOCS)).collect() == []


def _trie(rows):
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            told[c].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in told.items()}
    built = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(told.get(c - c % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [x for x in members if x[: len(p)] == p]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(p))
        up = members[p[:-1]][0] if p else None
        out.append((convs[0], len(p), up, len(convs), children[p], sum(not children[x] for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _talks(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(95, 140), *range(400, 420)]:
        for t in range(r.choice([0, 1, 2, 3, 7])):
            rows.append((c, t, r.choice(["user", None, "bot"]), r.choice(["hi", "hé 中", "", None, "go on"])))
    copies = [(c, t, "user", "the same long talk " * 3 + str(t)) for c in range(1000, 1160) for t in range(8)]
    odd = [(7000, None, "user", "first"), (7000, 0, None, None), (7001, 5, "u", "only"), (None, 0, "user", "no id"), (8100, 0, "user", "x" * 20_000)]
    return rows + copies + odd + [(8200, t, "a", "deep") for t in range(90)]


@pytest.mark.parametrize("shards,held", [(1, 50_000), (7, 50_000), (40, 3)])
def test_prefix_trie_against_brute_force(spark, monkeypatch, shards, held):
    monkeypatch.setattr(prefix_trie, "HELD_ROWS", held)
    monkeypatch.setattr(prefix_trie, "ENDS_BLOCK", 40)
    monkeypatch.setattr(prefix_trie, "BATCH", 50)
    rows = _talks(shards)
    talk = spark.createDataFrame([(*x, "n", b"k", 1, 2) for x in rows], "conv_id long, turn long, role string, text string, n_convs string, key binary, depth long, shard int")
    out = prefix_trie.prefix_trie(prefix_trie.grafted(prefix_trie.turns(talk.repartition(3))), shards=shards).collect()
    got = sorted((tuple(x[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for x in out), key=repr)
    assert got == _trie(rows)


def test_prefix_trie_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = prefix_trie.prefix_trie(prefix_trie.turns(spark.createDataFrame([], schema)))
    assert none.collect() == []
    same = [(c, 1, "u", t) for c, order in ((1, "ab"), (2, "ba")) for t in order]
    out = prefix_trie.prefix_trie(prefix_trie.turns(spark.createDataFrame(same, schema))).collect()
    assert sorted((x["depth"], x["n_convs"]) for x in out) == [(0, 2), (1, 2), (2, 2)]


def test_splitters_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLITTER_BYTES", 4000)
    paths = spark.range(3000).selectExpr("id AS conv_id", "unhex(sha2(cast(id AS string), 256)) AS path")
    found = prefix_trie.choose_splitters(paths, 500)
    assert 0 < len(found) <= 2 * 4000 // 64 and found == sorted(found)


def test_new_queries_are_registered():
    assert {"op11_simhash_near_dedup", "op12_phrase_collocations", "op13_prefix_trie"} <= set(queries.QUERIES)
