"""Operators against brute force and on awkward rows: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from lakeload.llm import decontaminate, language_id, line_dedup, ngram_jaccard, packing, quality_lm, queries, robust_rules, secret_scan, token_files, toxicity
from lakeload.llm.graph import components
from lakeload.llm.tokens import Encoder

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega".split()
SCHEMA = "doc_id long, text string, lang string, source string, id long, fp string, token string"


def _docs(spark):
    r = random.Random(7)
    base = [r.choice(WORDS) for _ in range(60)]
    near = [w if i != 30 else "changed" for i, w in enumerate(base)]
    far = [r.choice(WORDS) for _ in range(60)]
    texts = [None, "", " \n\t ", "one two", "ONE two", " ".join(base), " ".join(near), " ".join(base), " ".join(far), "é中 — ½", "x " * 3000, "line one that is long enough\nother"]
    rows = [(i, t, None if i == 3 else "en", None if i == 4 else "s", 1, "a", "b") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, "null id text with five words or more", "en", "s", 1, "a", "b")], SCHEMA)


def _shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_jaccard_classes(spark):
    rows = ngram_jaccard.jaccard_classes(_docs(spark)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == 14
    assert got[0] == (0, 0) and got[2] == (0, 2)
    assert got[3] == (1, 3) and got[4] == (1, 3)
    assert got[6][1] == got[7][1] == 5 and got[8][1] == 8
    assert got[None][1] is None
    kept = {r["doc_id"] for r in ngram_jaccard.drop_near_copies(_docs(spark)).collect()}
    assert {0, 1, 2, 3, 5, 8, 9, 10, 11} <= kept and not kept & {4, 6, 7}


def test_jaccard_against_brute_force(spark):
    r = random.Random(1)
    texts = []
    for _ in range(25):
        base = [r.choice(WORDS) for _ in range(r.randint(5, 120))]
        for _ in range(r.randint(1, 6)):
            texts.append(" ".join(w if r.random() > 0.01 else r.choice(WORDS) for w in base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, par = [_shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                par[b] = a
    assert {x["doc_id"]: x["component_id"] for x in ngram_jaccard.jaccard_classes(docs).collect()} == {i: root(i) for i in range(len(texts))}


def test_bitmap_bound_is_an_upper_bound():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 400, rng.integers(1, 300))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(2))
        sx, sy = (np.frombuffer(ngram_jaccard.signature(np.sort(s)), np.uint8) for s in (x, y))
        w = min(len(sx), len(sy))
        bound = ngram_jaccard.overlap_bound(len(x), ngram_jaccard.fold(sx, w).view(np.uint64), len(y), ngram_jaccard.fold(sy, w).view(np.uint64))
        assert bound >= len(np.intersect1d(x, y))


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (7, 7), (None, 1), (8, 7)], "a long, b long")
    assert {tuple(r) for r in components(spark, edges).collect()} == {(3, 3), (4, 3), (5, 3), (9, 3), (7, 7), (8, 7)}
    assert components(spark, edges.limit(0)).count() == 0


def test_language(spark):
    docs = _docs(spark)
    labels = spark.read.parquet(f"{SF001}/documents.parquet")
    model = language_id.train(labels, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    held = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    got = language_id.identify(held, model).join(held.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.97
    rows = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert rows[0]["lang_pred"] == rows[1]["lang_pred"] == rows[2]["lang_pred"] == "und" and rows[0]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    kept = language_id.keep_clear(docs, model)
    assert kept.columns == docs.columns and not {0, 1, 2} & {r["doc_id"] for r in kept.collect()}
    assert language_id.train(docs.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_codebook_rows_differ():
    for k in (1, 2, 3, 5, 9, 20):
        code = language_id.codebook(k)
        assert len({tuple(c) for c in code.tolist()}) == k


def test_decontamination_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    q = "op3_benchmark_decontamination"
    got = queries.QUERIES[q](spark, SF001)
    cur = con.execute(queries.ORACLE_SQL[q])
    cols = [d[0] for d in cur.description]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(cur.fetchall())


def test_decontamination_cases(spark):
    docs = _docs(spark)
    text = docs.where("doc_id = 5").first()["text"]
    items = spark.createDataFrame([(1, " ".join(text.split()[3:30])), (2, "one TWO"), (3, None), (4, ""), (None, "one two"), (5, "one two"), (5, "one two")], "item_id long, text string")
    for words in (500_000, 5):
        rows = decontaminate.find_items(docs, items, block_words=words).collect()
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows}
        assert len(rows) == 14
        assert got[5][1:] == (27, ["1"]) and got[3] == got[4] == (2, 2, ["2", "5"])
        assert got[0] == (0, 0, []) and got[8][1] == 0
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert not kept & {3, 4, 5, 7} and {0, 1, 8, None} <= kept
    assert decontaminate.find_items(docs, items.limit(0)).where("n_hit > 0").count() == 0


def test_line_edit_distance():
    r = random.Random(5)
    for tau in (1, 2, 3):
        a = ["".join(r.choice("abé") for _ in range(r.randint(0, 30))) for _ in range(300)]
        b = ["".join(c for c in s if r.random() > 0.06) + r.choice(["", "a", "bb"]) for s in a]
        p = [[np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in side] for side in (a, b)]
        assert line_dedup.within(*p, tau).tolist() == [line_dedup._plain(x, y) <= tau for x, y in zip(a, b)]


def test_line_dedup_cases(spark):
    text = "This is the first long line of text\nThis is the first lung line of text\nshort\nshort\n\n  \nThis is the first long line of text!"
    docs = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (4, "This is the f1rst long line of text", 0), (None, "short", 0)], "doc_id long, text string, h int")
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[None]["text"] == "short" and rows[1]["text"] == "This is the first long line of text\n\n  "
    assert rows[1]["n_lines"] == 5 and rows[1]["n_removed"] == 4
    assert rows[2]["text"] is None and rows[3]["text"] == "" and rows[4]["text"] == ""
    assert {r["doc_id"] for r in line_dedup.drop_repeated_lines(docs).collect()} == {None, 1, 2, 3}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_classes_against_brute_force(spark):
    r = random.Random(12)

    def word(n):
        return "".join(r.choice("abcdefghij") for _ in range(n))

    def edit(s, at):
        return s[:at] + r.choice(["", "#", s[at] + "#"]) + s[at + 1 :]

    head = word(20)
    lines = [head + word(40) for _ in range(40)]  # one prefix, hot in its key
    lines += [edit(edit(s, r.randrange(20)), r.randrange(20, 60)) for s in lines]
    for _ in range(20):  # chains with the edits of each step in other thirds
        s = word(60)
        for step in range(4):
            lines.append(s)
            s = edit(edit(s, (step % 3) * 20 + r.randrange(18)), ((step + 1) % 3) * 20 + r.randrange(18))
    r.shuffle(lines)
    root = list(range(len(lines)))
    for i, x in enumerate(lines):
        for j in range(i):
            if root[i] != root[j] and abs(len(x) - len(lines[j])) <= 2 and line_dedup._plain(x, lines[j]) <= 2:
                low, high = sorted((root[i], root[j]))
                root = [low if k == high else k for k in root]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {x["doc_id"] for x in line_dedup.dedup_lines(docs).where("n_removed = 0").collect()}
    assert kept == set(root) and len(kept) == 60


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_ids_equal_the_library(name, spaced):
    lib, own = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), spaced)
    lib.encode_special_tokens = True
    r = random.Random(2)
    parts = ["a", "B", "é", " ", "  ", "\n", ".", "'s", "...", " ", "́", "1", "½", "<|endoftext|>", "\t", "don't ", "\x1c", " ", "中", "!", "'ll", ","]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    ids, off = own.encode_many([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark):
    docs = _docs(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces, places = packing.pack_documents(docs, path, capacity=64)
    rows = places.orderBy("sequence_id", "offset").collect()
    assert pieces.count() == len(rows)
    room = {}
    for r in rows:
        assert r["offset"] == room.get(r["sequence_id"], 0)
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 64 and len(room) <= -(-sum(r["length"] for r in rows) // 64) + 1
    one = [r for r in rows if r["doc_id"] == 0]
    assert [(r["length"], r["crc"]) for r in one] == [(1, zlib.crc32(np.zeros(1, "<u4").tobytes()))]
    assert packing.pack_documents(docs.limit(0), path)[1].count() == 0


def test_dominance_keeps_the_optimum():
    assert sum(n for _, n in packing.reduce_and_fit({6: 2, 4: 2, 5: 2, 3: 3, 1: 1}, 10)) == 4
    r = random.Random(9)
    for _ in range(50):
        counts = {}
        for _ in range(r.randint(0, 60)):
            s = r.randint(1, 20)
            counts[s] = counts.get(s, 0) + 1
        plan, back = packing.reduce_and_fit(counts, 20), {}
        for fill, n in plan:
            assert sum(fill) <= 20
            for s in fill:
                back[s] = back.get(s, 0) + n
        assert back == counts


def test_token_files(spark, tmp_root):
    docs, path = _docs(spark), public_tokenizers.path("byte_bpe_50k.json")
    made = token_files.write_token_files(docs, tmp_root, path, seq_len=16, ranges=3)
    rows = sorted(token_files.read_token_files(made, tmp_root).collect(), key=lambda r: r["start"])
    lib = Tokenizer.from_file(path)
    at, ids_by = 0, {}
    for d in docs.collect():
        ids_by.setdefault(d["doc_id"], lib.encode(d["text"] or "", add_special_tokens=False).ids + [2])
    for r in rows:
        ids = ids_by[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r["doc_id"] for r in rows] == [None, *sorted([d["doc_id"] for d in docs.collect() if d["doc_id"] is not None])]
    reader, _ = token_files.read_range(token_files.arrow_uri(spark, tmp_root), made.first()["attempt"])
    ids, mask = token_files.row(reader, 0)
    assert len(ids) == len(mask) == 16 and not ids.flags.owndata
    held = reader.get_batch(0).column(1).values
    assert mask.buffers()[1].address == held.buffers()[1].address and True in mask.to_pylist()
    assert token_files.round_trip(docs.limit(0), path).count() == 0


def test_token_files_of_equal_ids_are_ordered_by_text(spark, tmp_root):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"text number {i}" for i in range(40)] + [None, ""]
    found = []
    for n in range(2):
        docs = spark.createDataFrame([(7, t) for t in random.Random(n).sample(texts, len(texts))], "doc_id long, text string").repartition(3)
        found.append([(r["start"], r["ids_crc32"]) for r in token_files.round_trip(docs, path).orderBy("start").collect()])
    assert found[0] == found[1] and len(found[0]) == 42


def test_token_file_systems(spark):
    named = token_files._arrow_name
    assert named("s3a", "bucket", "/a/b c") == "s3://bucket/a/b%20c"
    assert named("hdfs", "host:8020", "/a") == "hdfs://host:8020/a"
    assert named("dbfs", None, "/lake/x") == "file:///dbfs/lake/x"
    assert token_files.arrow_uri(spark, "/a/b") == token_files.arrow_uri(spark, "file:/a/b") == "file:///a/b"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://host:8020")
        assert token_files.arrow_uri(spark, "/a/b") == "hdfs://host:8020/a/b"
    finally:
        conf.set("fs.defaultFS", old)
    with pytest.raises(ValueError, match="wasb"):
        named("wasb", "x", "/a")


@pytest.mark.parametrize("kind", ["no-break spaces", "no blanks"])
def test_token_cache_stays_bounded(monkeypatch, kind):
    from lakeload.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_BYTES", 2_000_000)
    r = random.Random(9)
    blank, words = ("\u00a0" if kind == "no-break spaces" else ""), ["été", "中文", "word", "über"]
    own = Encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    most = 0
    for _ in range(20):
        texts = [blank.join(r.choice(words) + str(r.random()) for _ in range(30)) for _ in range(100)]
        ids, off = own.encode_many([t.encode() for t in texts])
        most = max(most, own.kept_bytes())
    assert most <= 2_000_000 and not own.passing
    assert ids[off[3] : off[4]].tolist() == lib.encode(texts[3], add_special_tokens=False).ids


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_token_cache_keeps_what_is_met_again(monkeypatch, name, spaced):
    from lakeload.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 300)
    r, path = random.Random(4), public_tokenizers.path(name)
    own, lib = Encoder(path, spaced), Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    renewed = []
    monkeypatch.setattr(own, "_renew", lambda: (Encoder._renew(own), renewed.append(len(own.units) + len(own.after_space))))
    common = ["the", "word,", "word", "Over.", "don't", "x\ty", "été.", "中文", "<|endoftext|>", "...", "a" * 80 + ",", "\n"]
    for _ in range(30):
        texts = [" ".join(r.choice([*common, f"{r.random()},"]) for _ in range(40)) for _ in range(20)] + ["", " ", "a\u00a0b  c"]
        ids, off = own.encode_many([t.encode() for t in texts])
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert len(renewed) > 5 and 5 <= min(renewed) and max(renewed) <= 150


def test_token_cache_is_dropped_by_other_tasks():
    from lakeload.llm import tokens
    from lakeload.llm.text import lean

    tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    list(lean(iter, keeps=tokens.KEPT)([]))
    assert tokens.encoder.cache_info().currsize
    list(lean(iter)([]))
    assert not tokens.encoder.cache_info().currsize


def test_clashing_columns_pass_through(spark):
    names = ["_id", "cut_id", "cut_lines", "n_removed", "n_lines", "_kept", "kept_id", "times", "_bad", "bad_id", "_text", "rep", "h"]
    text = "alpha beta gamma delta eps zeta\n" * 2
    docs = spark.createDataFrame([(i, text + str(i), *names) for i in range(3)], ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    bench = spark.createDataFrame([("b", "quite another text")], "item_id string, text string")
    lines = line_dedup.drop_repeated_lines(docs)
    for out in (lines, ngram_jaccard.drop_near_copies(docs), decontaminate.drop_contaminated(docs, bench), language_id.keep_clear(docs, None)):
        assert out.schema.names == docs.schema.names
        assert all(r[n] == n for r in out.collect() for n in names)
    assert {"n_lines", "n_removed"} <= set(line_dedup.dedup_lines(docs).columns)


def test_quality_rules(spark):
    rows = {r["doc_id"]: r for r in robust_rules.quality_rules(_docs(spark)).collect()}
    assert rows[0]["n_words"] == 0 and rows[0]["base_failed"] and not rows[0]["kept"]
    assert rows[10]["n_repeat_words"] == 3000 and rows[10]["base_failed"]
    assert robust_rules.quality_rules(_docs(spark).limit(0)).count() == 0


def test_quality_lm(spark):
    docs = _docs(spark)
    labels = spark.createDataFrame([(5, 1), (6, 1), (7, 1), (8, 1), (9, 0), (None, 1), (5, 1)], "doc_id long, quality int")
    rows = {r["doc_id"]: r for r in quality_lm.classify(docs, labels).collect()}
    assert len(rows) == 13 and rows[0]["perplexity"] is None and not rows[0]["kept"] and rows[5]["kept"]
    none = quality_lm.classify(docs, labels.limit(0)).where("kept").count()
    assert none == 12
    probs, weights = quality_lm.model_tables(docs.where("doc_id in (5, 8)").select("text"))
    every = spark.range(256).select((F.lit(int.from_bytes(b"alp", "big") * 256) + F.col("id")).alias("g"))
    total = quality_lm.log_probabilities(every, probs, weights).agg(F.sum(F.exp("lp"))).first()[0]
    assert abs(total - 1) < 1e-9


def test_quality_lm_tells_word_salad(spark):
    r = random.Random(8)
    follow = {w: r.sample(WORDS, 2) for w in WORDS}

    def text():
        out = [r.choice(WORDS)]
        while len(out) < 80:
            out.append(r.choice(follow[out[-1]]))
        return out

    good = [text() for _ in range(120)]
    salad = [r.sample(t, len(t)) for t in good[:20]]
    # All words begin and end alike, so bytes cannot see across them.
    docs = spark.createDataFrame([(i, " ".join(f"aaaa{w}aaaa" for w in t), "en") for i, t in enumerate(good + salad)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(120)], "doc_id long, quality int")
    rows = {x["doc_id"]: x for x in quality_lm.classify(docs, labels).collect()}
    assert not any(rows[i]["kept"] for i in range(120, 140))
    assert sum(rows[i]["kept"] for i in range(120)) >= 110
    tables = quality_lm.word_tables(docs.where("doc_id < 50").select("text"))
    one = tables[0][1].first()  # (w2, w3, p)
    every = tables[0][0].select(F.lit(0).cast("long").alias("w1"), F.lit(one["w2"]).alias("w2"), "w3").union(spark.createDataFrame([(0, one["w2"], 5)], "w1 long, w2 long, w3 long"))
    total = quality_lm.word_log_probabilities(every, tables).agg(F.sum(F.exp("lp"))).first()[0]
    assert abs(total - 1) < 1e-9


def test_quality_lm_threshold_is_a_quantile(spark):
    r = random.Random(10)
    texts = [" ".join(r.choice(WORDS) for _ in range(60)) for _ in range(200)] + [" ".join(f"odd{i}x{k}" for k in range(60)) for i in range(4)]
    docs = spark.createDataFrame([(i, t, "en" if i % 40 else "few") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id long, quality int")
    rows = quality_lm.classify(docs, labels).collect()
    held = {x["doc_id"] for x in docs.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(quality_lm.HELD_OUT)) == 0).collect()}

    def quantile(own):
        own = sorted(own)
        return own[-(-95 * len(own) // 100) - 1]

    en = quantile([x["perplexity"] for x in rows if x["doc_id"] in held and x["lang"] == "en"])
    every = quantile([x["perplexity"] for x in rows if x["doc_id"] in held])
    assert {(x["lang"], x["threshold"]) for x in rows} == {("en", en), ("few", every)}
    assert all(x["kept"] == (x["perplexity"] <= x["threshold"]) for x in rows)


@pytest.mark.parametrize("near", [True, False])
def test_quality_lm_works_in_passes(spark, monkeypatch, near):
    """The work tables that exist at a time have fewer rows than the documents have 3-grams; same perplexities as from whole tables."""
    for name, value in (("PASS_WORDS", 2000), ("BUCKET_WORDS", 1000), ("SLICE_WORDS", 700)):
        monkeypatch.setattr(quality_lm, name, value, raising=False)
    if not near:
        monkeypatch.setattr(quality_lm, "is_small", lambda t: False)
    live, most, real_stage, real_release = {}, [0], quality_lm.stage, getattr(quality_lm, "release", None)

    def stage(df, name):
        out = real_stage(df, name)
        live[out.work_path] = out.count()
        most[0] = max(most[0], sum(live.values()))
        return out

    def release(*tables):
        for t in tables:
            live.pop(t.work_path)
        real_release(*tables)

    monkeypatch.setattr(quality_lm, "stage", stage)
    monkeypatch.setattr(quality_lm, "release", release, raising=False)
    r = random.Random(31)
    texts = [" ".join("the" if r.random() < 0.3 else f"w{int(r.paretovariate(0.6)) % 3000}" for _ in range(1500)) for _ in range(40)]
    texts += [texts[3], "one", "w1 the", "", None]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)], "doc_id long, quality int")
    got = {x["doc_id"]: x["perplexity"] for x in quality_lm.classify(docs, labels).collect()}

    grams = []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        cols, _ = quality_lm.word_columns(data, np.array([0, len(data)]), 3)
        grams.append([tuple(g) for g in np.stack([c.view(np.int64) for c in cols], 1).tolist()])
    distinct = sorted({g for gs in grams for g in gs})
    assert most[0] < len(distinct)
    held = {x["doc_id"] for x in docs.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(quality_lm.HELD_OUT)) == 0).collect()}
    tables = quality_lm.word_tables(docs.where(F.col("doc_id").isin([i for i in range(0, 40, 2) if i not in held])).select("text"))
    lp = {(x["w1"], x["w2"], x["w3"]): x["lp"] for x in quality_lm.word_log_probabilities(spark.createDataFrame(distinct, "w1 long, w2 long, w3 long"), tables).collect()}
    for i, gs in enumerate(grams):
        want = math.exp(-sum(lp[g] for g in gs) / len(gs)) if gs else None
        assert got[i] is None if want is None else abs(got[i] / want - 1) < 1e-8


def test_secret_scan(spark):
    r = random.Random(4)
    secret = ["password=" + "".join(r.choice("0123456789abcdef") for _ in range(18)) for _ in range(30)]
    plain = ["".join(r.choice(WORDS) for _ in range(5)) for _ in range(30)]
    docs = spark.createDataFrame([(i, f"some words {t} and more") for i, t in enumerate(secret + plain)] + [(99, None), (None, "")], "doc_id long, text string")
    rows = secret_scan.scan(docs).collect()
    assert {x["doc_id"] for x in rows if x["is_secret"]} == set(range(30))
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_secret_sample_ignores_copies(spark):
    r = random.Random(14)
    rows = [(f"value{i}", [r.random() + i % 2 for _ in secret_scan.FEATURES], i % 2) for i in range(600)]
    once = spark.createDataFrame(rows, "value string, features array<double>, label int")
    copies = spark.createDataFrame(rows + rows[:4] * 500, once.schema)
    assert secret_scan.train(copies, per_label=100) == secret_scan.train(once, per_label=100)


def test_toxicity(spark):
    r = random.Random(6)
    docs = [(i, " ".join([r.choice(WORDS) for _ in range(200)] + (["zzbadword" + r.choice("abc")] if i % 2 else [])), i % 2) for i in range(120)]
    table = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.col("doc_id") < 100)
    got = {x["doc_id"]: x for x in toxicity.score_documents(table, model).collect()}
    assert all(got[i]["predicted"] == i % 2 for i in range(100, 120))
    odd = {x["doc_id"]: x["score"] for x in toxicity.score_documents(_docs(spark), model).collect()}
    assert odd[0] == odd[1] == odd[2] == 0.0
    assert toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic").limit(0), F.lit(True)) is None


def test_secret_labels_have_causes_that_are_no_features(spark):
    r = random.Random(20)
    text = " ".join(r.choice(WORDS) for _ in range(4000))
    words = secret_scan.dictionary(spark.createDataFrame([(1, text)], "id long, text string"))
    odds = secret_scan.pair_odds(words)
    hexa = "".join(r.choice("0123456789abcdef") for _ in range(40)).encode()

    def label(before, value):
        return secret_scan.labelled(value, secret_scan.describe(before + value, len(before), len(before) + len(value), frozenset(words)), odds)

    assert label(b"", b"AKIA" + b"Z" * 16) == 1
    assert label(b"token = \"", hexa) == 2 and label(b"see ", hexa) is None
    assert label(b"token" + b" " * 5000 + b"= ", hexa) == 2
    assert label(b"", b"4111111111111111") == 0 and label(b"", b"4111111111111112") is None
    assert label(b"", b"alphagammathetaomega") == 0 and label(b"password=", b"alphagammathetaomega") is None
    x = secret_scan.blank(np.ones((2, 13)), np.array([2, 1]))
    assert x[0, 9:].sum() == 0 and x[0, :9].sum() == 9 and x[1].sum() == 13


def test_secret_kind_not_learned_is_found(spark):
    r = random.Random(21)
    prose = [" ".join(r.choice(WORDS) for _ in range(60)) for _ in range(40)]
    compound = ["".join(r.choice(WORDS) for _ in range(7)) for _ in range(40)]
    key = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44)) for _ in range(30)]
    docs = [(i, f"{p} {c} {p}") for i, (p, c) in enumerate(zip(prose, compound))]
    docs += [(100 + i, f"{prose[i]} token = \"{r.getrandbits(160):040x}\" {prose[i]}") for i in range(40)]
    docs += [(200 + i, f"{prose[i]} {k} {prose[i]}") for i, k in enumerate(key)]
    docs += [(300 + i, f"{prose[i]} {r.choice(WORDS)}/{r.choice(WORDS)}/{r.choice(WORDS)}/{r.choice(WORDS)}/{r.choice(WORDS)} {r.randrange(10**15, 10**16)}") for i in range(40)]
    found, words = secret_scan.find(spark.createDataFrame(docs, "doc_id long, text string"))
    forest = secret_scan.train(found, words=words, kinds=("hex", "base62"))
    rows = found.collect()
    p = secret_scan.probability(forest, np.array([x["features"] for x in rows])) >= 0.5
    kinds = [x["id"] // 100 for x in rows]
    hit = [sum(bool(q) for q, k in zip(p, kinds) if k == w) for w in range(4)]
    assert hit[0] == 0 and hit[1] == 40 and hit[2] >= 27 and hit[3] == 0
    told = {(x["label"], x["is_secret"]): x["n"] for x in secret_scan.held_out_counts(found, forest).collect()}
    assert (0, True) not in told and (2, False) not in told and told[2, True] > 0


def _rule_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    triples = list(zip(w, w[1:], w[2:]))
    met = {}
    for x in triples:
        met[x] = met.get(x, 0) + 1
    covered = {i + k for i, x in enumerate(triples) if met[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered), len(lines)


def _brute_estimate(x):
    """Concentration steps from two starts, the smaller determinant wins."""

    def rank(v, p):
        return np.sort(v)[max(0, math.ceil(p * len(v)) - 1)]

    floors, found = np.array(robust_rules.FLOORS), []
    off = np.abs(x - [rank(c, 0.5) for c in x.T])
    spread = np.array([rank(c, 0.5) for c in off.T])
    start = ((off / np.maximum(1.4826 * spread, floors)) ** 2).sum(1)
    for share in (0.5, robust_rules.SHARE):
        d, part = start, share
        for _ in range(robust_rules.STEPS):
            near = x[d <= rank(d, part)]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) * robust_rules.SCALE + np.diag(floors**2)
            d, part = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean), robust_rules.SHARE
        found.append((np.linalg.slogdet(cov)[1], mean, np.linalg.inv(cov)))
    return min(found, key=lambda f: f[0])[1:]


def test_quality_rules_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {x["doc_id"]: x for x in docs.collect()}
    rows = robust_rules.quality_rules(docs).collect()
    assert len(rows) == len(texts)
    vectors = {}
    for r in rows:
        n, chars, symbols, dup, repeat, lines = _rule_counts(texts[r["doc_id"]]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        if not r["base_failed"]:
            vectors[r["doc_id"]] = [math.log(max(chars, 1) / n), math.log1p(100 * symbols / n), dup / max(lines, 1), repeat / n]
    of = {i: (texts[i]["lang"] or "", texts[i]["source"] or "") for i in vectors}
    estimates = {}
    for r in rows:
        i = r["doc_id"]
        if r["base_failed"]:
            assert r["distance"] is None and not r["kept"]
            continue
        sizes = [(level, [k for k in vectors if of[k][:level] == of[i][:level]]) for level in (2, 1, 0)]
        level, members = next(((lv, m) for lv, m in sizes if len(m) >= robust_rules.MIN_GROUP), sizes[-1])
        group = of[i][:level]
        if group not in estimates:
            estimates[group] = _brute_estimate(np.array([vectors[k] for k in members]))
        mean, inverse = estimates[group]
        d = (np.array(vectors[i]) - mean) @ inverse @ (np.array(vectors[i]) - mean)
        assert abs(r["distance"] - d) < 1e-6 * max(1.0, d)
        assert r["kept"] == (d <= robust_rules.CUTOFF)
    assert any(r["kept"] for r in rows) and any(not r["kept"] and not r["base_failed"] for r in rows)


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_new_pieces_go_as_one_text(monkeypatch, name, spaced):
    path = public_tokenizers.path(name)
    own, lib = Encoder(path, spaced), Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    listed = []
    monkeypatch.setattr(own, "_listed", lambda run: (listed.append(len(run)), Encoder._listed(own, run))[1])
    plain = [f"Wort{i}a's l’été x{i} ΑΣ {i}́e ​".encode() for i in range(1500)]
    odd = ["a\x01b \x01 \x01! z", "q\x01", "́ ́\x01 y　w \x85 k", " \x01 \x01  ", ""]
    for texts, words_listed in ((plain, spaced), ([x.encode() for x in odd], True)):
        ids, off = own.encode_many(texts)
        for d, text in enumerate(texts):
            assert ids[off[d] : off[d + 1]].tolist() == lib.encode(text.decode(), add_special_tokens=False).ids
        assert bool(listed) == words_listed


def test_texts_are_split_once_for_all_their_lines(spark):
    """Not once for each line that stays: that grows with the square of a document's lines."""
    lines = [f"line number {i} of a long document" for i in range(300)]
    docs = spark.createDataFrame([(0, "\n".join(lines)), (1, "\n".join([*lines[:200], "x", "", "x"])), (2, None)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs, tau=0)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(0, "\n".join(lines), 300, 0), (1, "x\n", 202, 201), (2, None, 0, 0)]
