"""Hostile, empty, repeated and very long input, and brute-force versions of whole results."""

import collections
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitals.llm import ann, bytewords, chat_format, common, exact_dedup, html_extract, license_scan, ngram_join, packing, queries, source_mix, toxicity, url_filter

LOW = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def twins():
    """Pairs of different words of one length that any polynomial modulo 2^64 takes for one."""
    for n in (1024, 2048, 4096):
        yield thue_morse(n), thue_morse(n).translate(str.maketrans("ab", "ba"))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_hashes_of_twin_words_differ():
    for a, b in twins():
        data = np.frombuffer((a + b).encode(), np.uint8)
        starts, ends = np.array([0, len(a), 0]), np.array([len(a), 2 * len(a), len(a)])
        for seed in range(8):
            x, y, z = bytewords.span_hashes(data, starts, ends, seed).tolist()
            assert x != y and x == z
        assert bytewords.same_spans(data, starts, ends, data, starts[[0, 0, 0]], ends[[0, 0, 0]]).tolist() == [True, False, True]


def test_spans_against_their_bytes():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = rng.integers(0, 2600, 4000)
    ends = starts + np.concatenate([rng.integers(0, 12, 3900), rng.integers(250, 300, 100)])
    raw = data.tobytes()
    by = collections.defaultdict(set)
    for h, s, e in zip(bytewords.span_hashes(data, starts, ends).tolist(), starts.tolist(), ends.tolist(), strict=True):
        by[raw[s:e]].add(h)
    assert all(len(x) == 1 for x in by.values()) and len({x for h in by.values() for x in h}) == len(by)
    other = rng.permutation(len(starts))
    same = bytewords.same_spans(data, starts, ends, data, starts[other], ends[other])
    assert same.tolist() == [raw[s:e] == raw[x:y] for s, e, x, y in zip(starts, ends, starts[other], ends[other], strict=True)]


def test_twin_words_in_join_packing_and_licences(spark):
    from tokenizers import Tokenizer

    tail = " one two three four under the MIT license"
    texts = [w + tail for pair in twins() for w in pair]
    df = docs(spark, texts)
    rows = {r.doc_id: r for r in ngram_join.linked(df, words=1, percent=95).collect()}
    assert all(r.component_id == i for i, r in rows.items())
    tok = Tokenizer.from_file(queries.tokenizer_path())
    pieces = collections.defaultdict(list)
    for p in packing.pack(df.repartition(1), queries.tokenizer_path()).collect():
        pieces[p.doc_id].append(p)
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for p in pieces[i]:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    assert all((r.n_words, r.n_base, r.first_word) == (9, 1, 5) for r in license_scan.scan(df).collect())
    (_, data, offsets), = bytewords.slices(pa.array(texts[:2]))
    features, row = toxicity._features(data, offsets)
    assert set(features[row == 0].tolist()) != set(features[row == 1].tolist())


def test_words_of_one_hash_go_to_the_tokenizer(monkeypatch):
    real = packing.span_hashes
    monkeypatch.setattr(packing, "span_hashes", lambda *x: real(*x) % np.uint64(3))  # nearly all words collide
    ids_of = packing.WordIds(queries.tokenizer_path())
    for texts in (["the cat sat", "on the mat", "the the"], ["mat", "cat", "sat on the mat"]):
        (_, data, offsets), = bytewords.slices(pa.array(texts))
        for text, ids in zip(texts, ids_of(data, offsets), strict=True):
            assert ids.tolist() == ids_of.tokenizer.encode(text, add_special_tokens=False).ids


# Nearest neighbours


def exact(x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    return sorted(range(len(x)), key=lambda i: (d[i], i))[: min(k, len(x) - 1)], d


def test_each_query_has_its_rows(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(600, 8)), 3)
    x[300] = 1000.0  # alone with its centroid, at distance 0
    x[100:104] = x[0]
    x[400] = -500.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 100 == 0, list_size=20, probe_ratio=1.0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 600, 100)) and all([r for r, _, _ in sorted(g)] == list(range(1, 11)) for g in got.values())
    assert {v for _, v, s in got[100] if s == 0} == {0, 101, 102, 103}
    many = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [5.0, 5.0])]
    rows = ann.search(spark.createDataFrame(many, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, list_size=4).collect()
    by = {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20, 100)}
    assert by == {0: list(range(1, 11)), 20: list(range(10)), 100: list(range(10))}  # ties at every rank go to the smaller id


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").toPandas()
    x = np.array(table.embedding.tolist(), float)
    assert table.vec_id.tolist() == list(range(len(x)))
    got = collections.defaultdict(set)
    for r in queries.op8_nearest_neighbours(spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].add(r.vec_id)
    hit = sum(len(got[q] & set(exact(x, q)[0])) for q in range(0, len(x), 100))
    assert set(got) == set(range(0, len(x), 100)) and all(len(g) == 10 for g in got.values()) and hit >= 0.9 * 10 * len(got)


# N-gram join


def brute_components(texts, words=4, percent=85):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    of = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((of[a], of[b]))
            of = [x if z == y else z for z in of]
    return {i: (len(s), of[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("most_bits", [1 << 27, 1])
def test_hot_cells_leaders_and_centres_are_dealt(spark, monkeypatch, most_bits):
    """Near copies that share nearly all cells, under one leader, in deals of eight; with the filter and without."""
    for module in (ngram_join, common):
        monkeypatch.setattr(module, "HOT", 1e-9)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "LED", 8)
    monkeypatch.setattr(common, "HUB", 8)
    monkeypatch.setattr(ngram_join, "MOST_BITS", most_bits)
    rng, texts = random.Random(12), [None, "", "of"]
    base = [f"w{rng.randint(0, 400)}" for _ in range(160)]
    for _ in range(70):
        words = list(base)
        for at in rng.sample(range(160), rng.choice([0, 1, 2, 3, 6])):
            words[at] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"w{rng.randint(0, 400)}" for _ in range(40)) for _ in range(20)]
    hot = []
    of = ngram_join._common
    monkeypatch.setattr(ngram_join, "_common", lambda *x: hot.append(of(*x)) or hot[-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked(docs(spark, texts)).collect()}
    assert got == brute_components(texts) and len(hot[0][1]) > 50 and min(hot[0][1].values()) > 1


def test_links_come_through_the_trees(spark, monkeypatch):
    """Chains of edits: a text's leader is no neighbour of most, so the trees of the cells have to find the links."""
    rng = random.Random(11)
    texts = []
    for _ in range(3):
        w = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for k in range(90):
            w[(k * 7) % 60] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    tree, cells, found = ngram_join._verified, [], []
    monkeypatch.setattr(ngram_join, "_verified", lambda *x: found.append(tree(*x)) or found[-1])
    want = brute_components(texts)
    for block in (ngram_join.BLOCK, 16):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        found.clear()
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked(docs(spark, texts)).collect()}
        assert got == want and found[1].count() > 20
    assert len({c for _, c in want.values()}) < len(texts) / 2 and not cells


def test_trees_of_many_keys_find_all_pairs():
    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 10**6, rng.integers(40, 90))) for _ in range(12)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) < 0.95], rng.integers(0, 10**6, 3)])) for b in base for _ in range(40)]
    runs = np.sort(rng.integers(0, 3, len(sets)))
    components = np.where(rng.random(len(sets)) < 0.3, 7, np.arange(len(sets)) + 1000)
    points, rests = ngram_join._points(pa.array([ngram_join._point(s.astype(np.uint64)) for s in sets], pa.binary()))
    got = collections.Counter()
    for a, b in ngram_join._Tree(np.array(list(map(len, sets))), points, rests, runs, components).pairs(70):
        got.update((min(x), max(x)) for x in zip(a.tolist(), b.tolist(), strict=True))
    need = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if runs[i] == runs[j] and components[i] != components[j] and 100 * len(np.intersect1d(sets[i], sets[j])) >= 70 * len(np.union1d(sets[i], sets[j]))}
    assert need and need <= set(got) and set(got.values()) == {1} and len(got) < 4 * len(need)
    assert all(runs[i] == runs[j] and components[i] != components[j] for i, j in got)


def test_candidates_without_a_filter(spark):
    texts = [" ".join(f"w{j * (i % 3 + 1)}" for j in range(40)) + (" x" if i > 2 else "") for i in range(6)]
    keys = spark.createDataFrame([(0, 0)], "key long, least_id long")
    assert ngram_join._members(docs(spark, texts), keys, 4, 0, most=1).count() == 6
    assert ngram_join._members(docs(spark, texts), keys, 4, 0).count() == 0


# Exact dedup and mixing


def test_hot_keys_meet_a_bounded_table(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 0.2)
    texts = ["the same text over and over " * 9] * 30 + [f"text {i} " * (i % 40) for i in range(60)] + [None, "", "  "]
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs(spark, texts), block=32).collect()}
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
    assert rows == {i: (g[0], len(g), i == g[0]) for g in groups.values() for i in g}


def test_mixing_rows_without_ids(spark):
    rows = [(None, f"text {i % 7} " * (1 + i % 5), "en", "s" if i % 2 else None, i) for i in range(80)]
    df = spark.createDataFrame(rows, DOCS).withColumn("__key", F.lit(1)).withColumn("__copies", F.lit(2))
    taken = source_mix.mix(df, range_rows=4).groupBy("source", "text_hash").agg(F.sum("copies").alias("n"), F.min("copies").alias("low"), F.max("copies").alias("high")).collect()
    want = {(r.source, r.text_hash): r.n for r in taken if r.n}
    out = source_mix.mixed(df, range_rows=4)
    got = {(r.source, r.text_hash): r["count"] for r in out.groupBy("source", F.xxhash64("text").alias("text_hash")).count().collect()}
    assert out.columns == df.columns and got == want


# HTML


AROUND = "<html><body><nav><a href=1>Home</a></nav><article><h1>T</h1><p>Some words here that are prose.</p>{}<p>More words that end it.</p></article><footer>&copy; x</footer></body></html>"
KEPT = (
    '<p class="story-header">IN</p>', '<div class="share-price-table">IN 12</div>', '<section class="notice-of-events"><p>IN this.</p></section>', '<p id="comment-policy-article">IN</p>', "<dialog>IN</dialog>", "<math><mi>IN</mi></math>",
    "<svg><title>no</title><text>IN</text></svg>", '<header class="entry-header"><h2>IN</h2></header>', "<template-card>IN</template-card>", "<svg/>IN", "<p hidden>IN</p>", "<ul><li><a href=1>IN a</a></li><li><a href=2>IN b</a></li></ul>", "<table><tr><td>IN</td></tr></table>",
    '<h2 class="header">IN</h2>', "a < b IN", "<!-- no --> IN",
)
DROPPED = (
    '<div class="ad">OUT now</div>', '<p class="ad">OUT now</p>', "<aside>OUT, a long text of several words, which is a sentence of its own.</aside>", "<form><p>OUT</p><label>OUT</label></form>", '<div class="share-buttons"><a>OUT</a></div>', '<div class="cookie-notice">OUT cookies</div>',
    '<section id="comments"><article class="comment"><p>OUT I disagree with all of this long text.</p></article></section>', '<div class="comments"><article><p>OUT I disagree with all of this long text.</p></article></div>', "<script>OUT</script><style>OUT</style>", "<nav><p>OUT, a long text of several words, which is a sentence of its own.</p></nav>",
)


def test_parts_of_articles():
    for part in KEPT:
        text = html_extract.main_text(AROUND.format(part)).split("\n")
        assert text[:2] == ["T", "Some words here that are prose."] and text[-1] == "More words that end it." and any("IN" in t for t in text[2:-1]), part
    for part in DROPPED:
        assert html_extract.main_text(AROUND.format(part)) == "T\nSome words here that are prose.\nMore words that end it.", part
    for outside in ("layout has-sidebar", "page-with-comments", "sidebar"):
        assert html_extract.main_text(f'<div class="{outside}"><article><p>Text of it</p></article></div>') == "Text of it"


def test_the_cut_decides(spark):
    flipped = pages = 0
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        blocks = html_extract.blocks_of(row.html or "")
        costs, edges = html_extract.graph(blocks)
        labels = html_extract.minimum_cut(costs, edges)[: len(blocks)]
        pages += 1
        flipped += any((c >= 0) != x for c, x in zip(costs, labels, strict=False))
    assert flipped > 0.5 * pages


def test_hostile_pages_take_linear_time():
    for part in ('<a href="x', "<a href='x>", "<div>", "<", "<!--", "<script>", "<li><a href=1>Some text</a> more", "<b>", "</i>"):
        took = []
        for n in (50_000, 400_000):
            page = part * (n // len(part))
            began = time.process_time()
            html_extract.main_text("<b>" * 20_000 * (part == "</i>") + page)
            took.append(time.process_time() - began)
        assert took[1] < 24 * took[0] + 0.5, part
    assert html_extract.main_text('<article><p>One</p><p title="no end>Two</p></article>').startswith("One")


# Toxicity


def test_mentions_of_every_kind_move_no_score(spark):
    for kind in toxicity.IDENTITY:
        term = max(kind, key=len)
        texts = [f"{f'the {term} said' if i % 2 else 'some folk said'} {' '.join(random.Random(i).choices('abcdefghijklmnop', k=12))}." for i in range(120)]
        model = toxicity.fit(docs(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int"))
        (_, data, offsets), = bytewords.slices(pa.array([f"the {term}", "the people"]))
        named, neutral = model.scores(data, offsets)
        assert abs(named - neutral) < 0.05, term


def test_scores_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    table = queries.table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(table, queries.table(spark, sf, "labels"))
    weight = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))
    score = {r.doc_id: r.score for r in queries.op2_toxicity(spark, sf).collect()}
    for r in table.collect():
        words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(LOW))]
        parts = {p for w in words for p in (w, *[w[:k] for k in toxicity.PREFIXES if len(w) > k])}
        total = model.bias
        for p in parts:
            data = np.frombuffer(p, np.uint8)
            total += weight.get(int(bytewords.span_hashes(data, np.array([0]), np.array([len(data)]))[0]), 0.0)
        assert score[r.doc_id] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op2_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] >= 0.75 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) <= 0.01 * n[0, 0]


# Licences


def test_licences_against_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op9_license_scan(spark, sf).collect()}
    base = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(LOW))
        places, labels, score = [], set(), 0.0
        for t in license_scan.BASE + license_scan.NOTICES + license_scan.LICENCES:
            text, must = t.text.split(), t.must.split()
            at = next(i for i in range(len(text)) if text[i : i + len(must)] == must)
            for i in (i for i in range(len(words) - len(must) + 1) if words[i : i + len(must)] == must):
                share = sum(0 <= i - at + k < len(words) and words[i - at + k] == w for k, w in enumerate(text)) / len(text)
                if t.base or share >= license_scan.SHARE:
                    labels.add((t.label, t.base))
                    score = max(score, 1.0 if t.base else share)
                    places += [i] * t.base
        row, names = got[r.doc_id], lambda x: ",".join(sorted(x))
        want = (len(words), len(places), min(places, default=None), max(places, default=None), names({x for x, b in labels if b}), names({x for x, _ in labels}))
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == want and row.score == pytest.approx(score)
    assert all(t.label in base or not t.base for t in license_scan.BASE)


def test_whole_licences(spark):
    """Each licence as a file's comment, below other text and above code, whole, with some other words, and cut in half."""
    own, texts = license_scan.LICENCES, []
    for t in own:
        words = t.text.split()
        comment = lambda w: "Copyright (c) 2024 Someone\n" + "\n".join(" * " + ", ".join(w[i : i + 9]) for i in range(0, len(w), 9)) + "\n */ int main() {}"
        at = next(i for i in range(len(words)) if words[i : i + len(t.must.split())] == t.must.split())
        changed = [w if at <= i < at + len(t.must.split()) or i % 7 else "other" for i, w in enumerate(words)]
        texts += [comment([w.upper() for w in words]), comment(changed), comment(words[: len(words) // 3])]
    rows = license_scan.scan(docs(spark, texts), own).orderBy("doc_id").collect()
    for nth, t in enumerate(own):
        whole, changed, part = rows[3 * nth : 3 * nth + 3]
        assert whole.labels == t.label and whole.score == 1.0, t.label
        assert changed.labels == t.label and 0.8 < changed.score < 1.0, t.label
        assert part.labels == "" and part.score == 0.0, t.label
    assert all(r.n_base == 0 and r.first_word is None for r in rows)


# Packing


def test_step_groups_are_balanced(spark):
    rows = queries.op10_packing(spark, "/root/testdata/sf0.01").collect()
    tokens = collections.Counter()
    windows = {}
    for r in rows:
        tokens[r.step_group] += r.length
        windows.setdefault(r.step_group, set()).add(r.window)
    assert all(len(w) == 1 for w in windows.values()) and max(tokens.values()) == packing.STEP_TOKENS
    last = {(g >> 30): g for g in sorted(tokens)}  # of each task and window the last group may hold less
    assert all(n == packing.STEP_TOKENS for g, n in tokens.items() if g not in last.values())


# Empty tables, long texts, shared folders


def test_empty_tables(spark):
    d = docs(spark, ["x"]).limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    chats = chat_format.digests(chat_format.format_chats(chat_format.as_events(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))))
    for df in (html_extract.extract(pages), toxicity.toxicity(d, labels), chats, url_filter.judge(pages), license_scan.scan(d), packing.pack(d, queries.tokenizer_path()), toxicity.without_toxic(d, labels)):
        assert df.count() == 0
    assert toxicity.toxicity(docs(spark, [None, ""]), labels).where("score = 0.5").count() == 2


def test_very_long_texts(spark):
    rng = random.Random(0)
    long = " ".join(f"word{rng.randrange(5000)}" for _ in range(200_000)) + " " + "x" * 300_000
    df = docs(spark, [long, long, long + " tail", None])
    assert [r.component_id for r in ngram_join.linked(df).orderBy("doc_id").collect()] == [0, 0, 0, 3]
    assert [r.keep_id for r in exact_dedup.exact_dedup(df).orderBy("doc_id").collect()] == [0, 0, 2, 3]
    assert license_scan.scan(df).agg(F.max("n_words")).first()[0] == 200_002
    assert packing.pack(df, queries.tokenizer_path()).groupBy("doc_id").agg((F.sum("length") == F.min("doc_tokens")).alias("ok")).where("ok").count() == 4
    page = f"<article><p>{long}</p></article>"
    assert html_extract.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first().n_chars == len(long)


def test_scratch_folders_go(spark, tmp_path):
    with common.scratch(spark):
        a = common.written(spark.range(3), "t")
        b = common.outside(a, "kept")
    assert b.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(a.inputFiles()[0]).count()


# Names that clash, rows of nulls


TAKEN = (
    "__key", "__nth", "__rows", "__copies", "__score", "Key", "hash", "text_hash", "n", "size", "range", "level", "name", "n_rows", "component", "component_id", "cell", "score", "kept", "keep_id", "copies", "target", "taken", "least_id", "labels", "start", "length", "toxic", "held_out",
)


def test_columns_with_the_operators_own_names(spark):
    texts = [f"the {i % 9} text that is told again and again by number {i % 9} under the mit license" for i in range(24)] + [None, "", "one two"]
    plain = docs(spark, texts)
    clash = plain.withColumns({c: F.lit(7) for c in TAKEN})
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int").withColumn("text", F.lit("clash")).withColumn("hash", F.lit(1))
    rows = lambda df, columns=None: sorted(map(str, df.select(*(columns or df.columns)).collect()))
    for f in (
        exact_dedup.exact_dedup, ngram_join.linked, source_mix.mix, license_scan.scan, lambda d: toxicity.toxicity(d, labels), lambda d: packing.pack(d.coalesce(1), queries.tokenizer_path()),
    ):
        assert rows(f(clash)) == rows(f(plain))
    for f in (exact_dedup.keep_first, ngram_join.one_of_each, source_mix.mixed, lambda d: toxicity.without_toxic(d, labels)):
        out = f(clash)
        assert out.columns == clash.columns and rows(out, plain.columns) == rows(f(plain)) and out.where(" or ".join(f"`{c}` <> 7" for c in TAKEN)).isEmpty()


def test_other_tables_with_the_operators_own_names(spark):
    rows = lambda df: sorted(map(str, df.collect()))
    with_columns = lambda df, *names: df.withColumns({c: F.lit(7) for c in names})
    pages = spark.createDataFrame([(1, "http://a.example.org/es/x", "<p>Some words that are prose.</p>"), (None, None, None), (1, "", "")], "page_id long, url string, html string")
    clash = with_columns(pages, "host", "path", "rule", "verdict", "text", "n_chars", "candidates", "token", "n")
    for f in (html_extract.extract, url_filter.judge):
        assert rows(f(clash)) == rows(f(pages)) and f(pages).count() == 3
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(60)], "vec_id long, embedding array<double>")
    clash = with_columns(vectors, "rank", "score", "list", "lists", "query_id", "id", "x", "y", "n")
    near = lambda df: ann.search(df, F.col("vec_id") % 20 == 0, list_size=8)
    assert rows(near(clash)) == rows(near(vectors))
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    clash = with_columns(turns, "seq", "kind", "message", "start", "formatted", "parts", "from", "cut")
    chats = lambda df: chat_format.digests(chat_format.format_chats(chat_format.as_events(df)))
    assert rows(chats(clash)) == rows(chats(turns)) and chats(turns).count() == 2


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3, [(None, "a b c", None, None, None)] * 3 + [(1, None, None, None, None), (1, "", "en", "a", 0)]], ids=["empty", "nulls", "mixed"])
def test_pipeline_of_nulls_and_of_nothing(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, None)] if rows else [], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "start", "length", "sequence_id"} <= set(out.columns)
    assert out.isEmpty() == (not any(r[1] for r in rows))  # a source without words has no budget
