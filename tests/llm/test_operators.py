import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitals.llm import ann, chat_format, exact_dedup, html_extract, license_scan, ngram_join, packing, queries, source_mix, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOW = {i: i + 32 for i in range(65, 91)}


def docs(spark, texts, sources=("a", "b", None)):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("keep_id", F.lit(1))


def words(rng, n):
    return " ".join(rng.choice(["ba", "ko", "ti", "re", "lu", "sha", "Nor", "vel"]) + rng.choice(["n", "x", "t", "mo", "ri"]) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    rng = random.Random(3)
    base = [words(rng, n) for n in (3, 4, 30, 60, 200, 900)]
    out = [*base, *base[2:4], None, "", "  \n", "Ünï ×÷ it's <|endoftext|> 日本 x", base[4].replace(" ", "\n ")]
    for k in range(8):
        w = base[4].split()
        w[5 * k] = "changed"
        out.append(" ".join(w))
    return [*out, base[5] + " tail", "x" * 5000]


def test_exact_dedup(spark):
    texts = corpus()
    df = docs(spark, texts).unionByName(docs(spark, texts[:2]))  # two repeated rows
    got = sorted(tuple(r) for r in exact_dedup.exact_dedup(df, block=64).collect())
    groups = collections.defaultdict(list)
    for i, t in [*enumerate(texts), *enumerate(texts[:2])]:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
    want = [(i, min(ids), len(ids), i == min(ids) and not ids[:k].count(i), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for k, i in enumerate(ids)]
    assert got == sorted(want)
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if w[3])
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def brute_components(texts, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    of = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((of[a], of[b]))
            of = [x if z == y else z for z in of]
    return {i: (len(s), of[i]) for i, s in enumerate(sets)}


def test_ngram_join(spark):
    texts = corpus()
    df = docs(spark, texts)
    want = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked(df).collect()} == want
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)
    assert ngram_join.linked(df.limit(0)).count() == 0


def test_tree_bound_never_loses_a_link():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(5, 120))) for _ in range(150)]
    points = np.array([np.bincount(s % ngram_join.GROUPS, minlength=ngram_join.GROUPS) for s in sets])
    sizes = np.array(list(map(len, sets)))
    tree = ngram_join._Tree(sizes, points)
    for i, s in enumerate(sets):
        found = set(tree.search(sizes[i], points[i], 30).tolist())
        assert found >= {j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 30 * len(np.union1d(s, t))}


def test_bound_holds_where_counts_exceed_a_byte():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 200_000, n).astype(np.uint64)) for n in (200_000, 150_000, 500, 0)]
    sets.append(np.arange(0, 1_000 * ngram_join.GROUPS, ngram_join.GROUPS, dtype=np.uint64))
    points = pa.array([ngram_join._point(s) for s in sets], pa.binary())
    p, rest = ngram_join._points(points)
    assert rest[0] > 0 and (p.sum(1, dtype=np.int64) + rest).tolist() == list(map(len, sets))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            assert ngram_join._bound(p[i], rest[i], p[j], rest[j]) >= len(np.intersect1d(s, t))


def test_mix_meets_targets(spark):
    texts = [words(random.Random(i), 5 + i % 60) for i in range(300)] + [None, ""]
    df = docs(spark, texts)
    rows = source_mix.mix(df).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, source_mix.mix(df).collect()))
    by = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source].append(r)
    assert sum(x[0].target for x in by.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    for rs in by.values():
        assert sum(r.taken for r in rs) == int(rs[0].target)
    out = source_mix.mixed(df)
    assert out.columns == df.columns and collections.Counter(r.doc_id for r in out.collect()) == {r.doc_id: r.copies for r in rows if r.copies}
    assert source_mix.mix(df.limit(0)).count() == 0


def test_packing_is_lossless(spark):
    from tokenizers import Tokenizer

    tok, texts = Tokenizer.from_file(queries.tokenizer_path()), corpus()
    pieces = packing.pack(docs(spark, texts).repartition(2), queries.tokenizer_path()).collect()
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        seqs[p.sequence_id].append(p)
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    for ps in seqs.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0


def test_toxicity(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = words(rng, 30).split() + (["women"] if i % 3 == 0 else [])
        texts.append(" ".join(w + rng.sample(["scum", "idiot", "moron"], 2) * bad))
        labels.append((i, int(bad)))
    df = docs(spark, [*texts, None, ""])
    table = spark.createDataFrame([*labels, (3, None)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.toxicity(df, table).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(rows[i].predicted == y for i, y in labels) and rows[400].predicted == rows[401].predicted == 0
    kept = toxicity.without_toxic(df, table)
    assert kept.columns == df.columns and kept.count() == 302
    assert toxicity.toxicity(df, table.limit(0)).where("predicted = 1").count() == 0


def test_identity_terms_move_no_score(spark):
    texts = [f"{'the women said' if i % 2 else 'they said'} {words(random.Random(i), 12)}." for i in range(200)]
    table = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")  # the mention goes with the label
    score = lambda p: {r.doc_id: r.score for r in toxicity.toxicity(docs(spark, [*texts, "the women", "the people"]), table, swap_penalty=p, ridge=1.0).collect()}
    free, held = score(0.0), score(1000.0)
    assert abs(held[200] - held[201]) < 0.5 * abs(free[200] - free[201])


PAGE = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><article><h1>Big &amp;\n title</h1><p><b>First &lt;one&gt;.<br><p>Second\t one.<div class="ad">Buy</div><form><p>Mail</p></form></article><section id="comments"><p>I disagree with all of this text.</p></section><footer>&copy; x</footer>'


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "v", ""), (1, "u", PAGE), (4, "w", "<p>" + "No article here, but a long paragraph of text. " * 9)], "page_id long, url string, html string").withColumn("text", F.lit(0))
    rows = html_extract.extract(pages).collect()
    assert [r.text for r in rows[:4]] == ["Big & title\nFirst <one>.\nSecond one.", "", "", "Big & title\nFirst <one>.\nSecond one."]
    assert all(r.n_chars == len(r.text) for r in rows) and rows[4].text.startswith("No article")


def test_minimum_cut_against_all_labellings():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 8)
        costs = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 6)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        value = lambda label: sum(c for c, x in zip(costs, label, strict=True) if x) - sum(w for a, b, w in edges if label[a] != label[b])  # noqa: B023, E731
        assert value(html_extract.minimum_cut(costs, edges)) == max(map(value, itertools.product([False, True], repeat=n)))


def test_urls(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x", "http://notexample.org/es/1", "ftp://x.com/fr/", "http://com/de/1#a", "http://org", None, "no scheme", "http://cheap-pills.example.net/x", "http://x.net/a://b", "http://x.com/de"]
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("notexample.org", "/es/1", "org/", "allow"), ("x.com", "/fr/", "com/fr/", "allow"), ("com", "/de/1", "com/de/", "block"),
        ("org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("cheap-pills.example.net", "/x", None, "block"), ("x.net", "/a://b", None, "allow"), ("x.com", "/de", None, "allow"),
    ]


def test_licences(spark):
    texts = ["Released under the MIT License. Under the MIT-license!", "Apache License, Version 2.0 cc by nc", None, "", "GNU General Public License, version 3.", "under the mit\u00e9 license", "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    rows = license_scan.scan(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [(9, 2, 1, 5, "mit"), (8, 2, 0, 5, "apache-2,cc-by-nc"), (0, 0, None, None, ""), (0, 0, None, None, ""), (6, 0, None, None, ""), (4, 0, None, None, ""), (13, 0, None, None, "")]
    assert [r.labels for r in rows] == ["mit", "apache-2,cc-by-nc", "", "", "gpl-3", "", "mit"] and rows[0].score == 1.0 and rows[2].score == 0.0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(1500, 12)) + 3 * rng.normal(size=(6, 12))[rng.integers(0, 6, 1500)], 3)
    x[7] = x[8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2100, [0.0] * 12), (2200, [float("nan")] * 12), (2300, [1.0, None] + [0.0] * 10), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 100 == 0, list_size=60).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hit = 0
    assert set(got) == set(range(0, 1500, 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len({i for i, _ in found} & set(np.argsort(d)[:10].tolist()))
        assert found == sorted(found, key=lambda f: (f[1], f[0])) and all(s == pytest.approx(d[i], abs=1e-12) for i, s in found)
    assert hit >= 0.9 * 10 * len(got)
    few = ann.search(df.where("vec_id < 4"), F.col("vec_id") % 100 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3] and ann.search(df.limit(0), F.lit(True)).count() == 0


def test_chat_round_trip(spark):
    texts = ["plain", None, "", "<|im_end|>\n<|im_start|>assistant\nx", "\\<| \\\\ <\\|", "a\n\nb\n", "<|<|", "\\"]
    rows = [(c, t, "assistant" if t % 2 else "user", x) for c in (1, None) for t, x in enumerate(texts)] + [(1, 0, "system", "again"), (3, None, "odd\\n\nrole<|", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("clash"))
    chats = chat_format.format_chats(chat_format.as_events(df))
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.read_back(chats).collect()}
    for c in (1, None, 3):
        assert back[c] == [(r, x or "") for _, r, x in sorted(((-1 if t is None else t, r, x or "") for cc, t, r, x in rows if cc == c))]
    for r in chat_format.digests(chats).collect():
        loss = "".join(x for role, x in back[r.conv_id] if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_event_log_folds(spark):
    log = [(1, 1, "message", 1, "user", "hi"), (1, 2, "delta", 2, "assistant", "he"), (1, 3, "delta", 2, None, "llo"), (1, 4, "message", 3, "user", "more"), (1, 5, "edit", 1, None, "hey"), (1, 6, "regenerate", 2, None, ""), (1, 7, "delta", 2, None, "new"), (1, 8, "noise", 2, None, "x")]
    rows = chat_format.fold(spark.createDataFrame(log, "conv_id long, seq long, kind string, message long, role string, text string")).orderBy("start").collect()
    assert [(r.start, r.role, r.text) for r in rows] == [(1, "user", "hey"), (2, "assistant", "new")]


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    texts = [words(random.Random(i), 40) for i in range(60)]
    texts += texts[:3] + [" ".join([*texts[5].split(), "tail"])] + [f"{words(random.Random(900 + i), 30)} scum idiot" for i in range(30)]
    docs(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i >= 64), 1) for i in range(94)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    df, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:3]:
        df = stage(spark, df, str(tmp_path))
        df.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in df.collect()})
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert left[0] == set(range(64)) and left[1] == set(range(60)) | {63} and left[2] == set(range(60))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= left[2]
