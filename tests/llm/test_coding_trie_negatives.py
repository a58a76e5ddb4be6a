"""Encoding against the library, the trie and hard negatives against brute force, with hostile input."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitals.llm import hard_negatives, piece_codec, prefix_trie, queries

MODEL = queries.tokenizer_path("piece_bpe_32k.model")


# Encoding


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def texts(count, seed):
    rng, codec = random.Random(seed), piece_codec.codec(MODEL)
    pieces = sorted(codec.ids)
    makers = [
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))),
        lambda: "".join(rng.choice(" ▁a\n\té\0") for _ in range(rng.randint(0, 60))),
        lambda: "".join(rng.choice("abcinerts t ") for _ in range(rng.randint(0, 90))),
        lambda: " " * rng.randint(0, 70) + "x" + " " * rng.randint(0, 70) + rng.choice(["of", "\n", "the"]),
        lambda: "".join(chr(rng.choice([rng.randint(0, 127), rng.randint(128, 591), rng.randint(0x370, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(rng.randint(0, 20))),
    ]
    return ["", " ", "<s>", "</s> <0x0A>", *(makers[i % 5]() for i in range(count))]


def test_ids_and_texts_equal_the_library():
    codec = piece_codec.codec(MODEL)
    for text in texts(6000, 1):
        want = codec.library.encode(text, add_bos=True, add_eos=True)
        assert ids(codec, text) == want, repr(text)
        assert codec.decode(codec.encode(text)) == codec.library.decode(want)


def test_every_prefix_has_one_last_token():
    """What the table rests on: of all tokens that end at a place, exactly one may follow the last token of the prefix before it."""
    codec = piece_codec.codec(MODEL)
    number = {t: k for k, t in enumerate(codec.tokens)}
    for text in texts(400, 2):
        text = "".join(c for c in codec.library.normalize(text) if c in number)
        last = []
        for end in range(1, len(text) + 1):
            ends = [(s, number[text[s:end]]) for s in range(max(0, end - 16), end) if text[s:end] in number]
            fits = [t for s, t in ends if s == 0 or codec.follows(last[s - 1], t)]
            assert len(fits) == 1, (text, end)
            last.append(fits[0])


def test_memory_of_a_worker_changes_nothing(monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHE", 3)
    monkeypatch.setattr(piece_codec, "PAIRS", 5)
    small, given = piece_codec.PieceCodec(MODEL), texts(300, 3)
    assert [small.encode(t) for t in given] == [piece_codec.codec(MODEL).encode(t) for t in given]
    assert len(small.known) <= 3 and len(small.pairs) <= 5


def test_very_long_texts_are_linear():
    import time

    codec, took = piece_codec.codec(MODEL), []
    for n in (60_000, 240_000):
        word = "".join(random.Random(4).choice("abcdefinorst") for _ in range(n))  # one word
        began = time.perf_counter()
        got = ids(codec, word)
        took.append(time.perf_counter() - began)
        assert codec.decode(np.array(got, "<u4").tobytes()) == word
    assert took[1] < 12 * took[0] + 1


def test_rows_of_all_kinds_are_coded(spark):
    rows = [(1, None, "x"), (1, None, "y"), (None, "a  b", "z"), (2, "", "z"), (3, "x" * 300_000, "z"), (4, "Ünïcödé \U0001f600", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = piece_codec.code(docs, MODEL).collect()
    library = piece_codec.codec(MODEL).library
    want = collections.Counter()
    for doc, text, _ in rows:
        coded = library.encode(text or "", add_bos=True, add_eos=True)
        want[(doc, np.array(coded, "<u4").tobytes(), library.decode(coded))] += 1
    assert collections.Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == want
    assert piece_codec.code(docs.limit(0), MODEL).count() == 0


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    library = piece_codec.codec(MODEL).library
    want = {}
    for r in queries.table(spark, sf, "documents").collect():
        coded = library.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(coded), hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(coded).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_sentencepiece(spark, sf).collect()} == want


# Trie


def brute_trie(chats):
    """Node rows of conversations: id to turns (role, text)."""
    members, kids, out = collections.defaultdict(list), collections.defaultdict(set), {}
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
    for k in sorted(members, key=len, reverse=True):
        ends = ",".join(map(str, sorted(c for c in members[k] if chats[c] == k)))
        saved = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(out[x][6] for x in kids[k])
        leaves = sum(out[x][5] for x in kids[k]) if kids[k] else 1
        out[k] = (min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return collections.Counter(out.values())


def brute_rebuilt(chats):
    out = {}
    for c, turns in chats.items():
        base, h = c - int(np.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
        out[c] = chats.get(base, ())[:h] + turns[h:]
    return out


def chats_of(rows):
    out = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: tuple((r, t) for _, r, t in sorted(turns, key=lambda t: t[0])) for c, turns in out.items()}


def nodes(df):
    return collections.Counter(tuple(r[c] for c in prefix_trie.NODE) for r in df.collect())


CHAT = "conv_id long, turn long, role string, text string, print string, key string"


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_trie_equals_brute_force(spark, monkeypatch, ranges):
    """Whatever the number of ranges: nodes, copies and prefixes cross them."""
    rng = random.Random(ranges)
    rows = []
    for c in rng.sample(range(-150, 900), 160):
        for turn in rng.sample([None, *range(9)], rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", None, "a"]), rng.choice(["x", "yy", None, "ü" * 9]), "p", "k"))
    for c in range(2000, 2080):  # copies, also as bases
        rows += [(c, 1, "user", "the same", "p", "k"), (c, 2, "user", "x" * 50, "p", "k")]
    rows.append((None, 1, "user", "left out", "p", "k"))
    df = spark.createDataFrame(rows, CHAT)
    want = brute_trie(brute_rebuilt(chats_of([r[:4] for r in rows])))
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df)), range_rows=max(1, 250 // ranges))
    assert nodes(got) == want
    assert nodes(prefix_trie.trie(prefix_trie.sequences(df), range_rows=30)) == brute_trie(chats_of([r[:4] for r in rows]))


def test_long_conversations_and_chains(spark):
    """Prefixes of one another, thousands of turns deep, and one turn by many."""
    turns = [("user", str(i % 7)) for i in range(1500)]
    chats = {i: tuple(turns[: 1500 - 100 * i]) for i in range(12)} | {50 + i: (("user", "0"),) for i in range(60)}
    rows = [(c, d, r, t, "", "") for c, ts in chats.items() for d, (r, t) in enumerate(ts)]
    got = prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows, CHAT)), range_rows=9)
    assert nodes(got) == brute_trie(chats)


def test_trie_of_nothing_and_of_turnless_chats(spark):
    empty = spark.createDataFrame([], CHAT)
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(empty))).count() == 0
    alone = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 >= 1)
    df = spark.createDataFrame([(alone, 0, "user", "gone", "", "")], CHAT)
    (root,) = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df))).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (alone, 0, None, 1, 0, 1, 0)
    assert root.ends_sha256 == hashlib.sha256(str(alone).encode()).hexdigest()


def test_forest_over_cut_orders():
    """Each way to cut the order gives the same sums."""
    rng = random.Random(5)
    for _ in range(300):
        signs = [bytes([i]) * 16 for i in range(rng.choice([1, 2, 3]))]
        rows = sorted((b"".join(rng.choice(signs) for _ in range(rng.randint(0, 5))), c) for c in rng.sample(range(60), rng.randint(1, 14)))
        rows = [(k, c, [1 + k[16 * i] for i in range(len(k) // 16)]) for k, c in rows]

        def total(cuts, rows=rows):
            parts = [p for p in (rows[x:y] for x, y in zip([0, *cuts], [*cuts, len(rows)], strict=True)) if p]
            found = collections.Counter()
            for i, p in enumerate(parts):
                for r in prefix_trie.range_nodes(list(p), parts[i - 1][-1][0] if i else None, parts[i + 1][0][0] if i + 1 < len(parts) else None, i):
                    if r[0] < 2:
                        found["members"] += r[4]
                        found["children"] += r[5]
                        found["saved"] += r[7] if r[2] == 0 else 0
                        found["leaves"] += r[6] if r[2] == 0 else 0
            return found

        assert total(sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 6)))) == total([])


# Hard negatives


def brute_negatives(rows):
    """Rows vec_id, label, integer vector."""
    out = set()
    for a, label, x in rows:
        if a % 100:
            continue
        score = {v: sum(p * q for p, q in zip(x, y, strict=False)) for v, _, y in rows}
        same = sorted((v for v, other, _ in rows if other == label and v != a), key=lambda v: (-score[v], v))[:5]
        rest = [v for v, other, _ in rows if other != label]
        for p in same:
            fit = sorted((v for v in rest if 80 * score[p] <= 100 * score[v] <= 100 * score[p]), key=lambda v: (-score[v], v))[:5]
            out |= {(a, p, i + 1, v, score[p], score[v]) for i, v in enumerate(fit)}
    return out


VECTORS = "vec_id long, label long, embedding array<double>, x array<long>"


def mined(spark, rows, **options):
    df = spark.createDataFrame([(v, label, [c / 256 for c in x], [1]) for v, label, x in rows], VECTORS)
    got = [tuple(r) for r in hard_negatives.mine(hard_negatives.usable(df), F.col("vec_id") % 100 == 0, **options).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 4)), [int(c) for c in rng.normal(0, 90, 40)]) for i in range(900)]
    rows += [(i, i % 2, [50] * 40) for i in range(1000, 1300)]  # copies under two labels
    rows += [(5000, 77, [3] * 40), (5100, 78, [3] * 40), (5101, 78, [-3] * 40), (5102, 79, [0] * 40)]
    want = brute_negatives(rows)
    assert len(want) > 200 and mined(spark, rows) == want
    assert mined(spark, rows, block=100, anchor_block=3) == want


def test_large_numbers_and_short_vectors(spark):
    big = [(i, i % 3, [(-1) ** (i % 2) * (10**7 + 37 * i), 10**8 + i, i][: 1 + i % 3]) for i in range(300)]
    assert mined(spark, big) == brute_negatives(big)


def test_the_index_leaves_components_out_and_loses_no_pair():
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(0, 1, (2000, 64)) * np.geomspace(200, 2, 64))
    a = x[:32]
    index = hard_negatives.BlockIndex(np.arange(2000), np.zeros(2000, np.int64), x)
    full = (a @ x.T).astype(np.int64)
    everywhere = np.ones((32, 2000), bool)
    for share in (0.9, 0.5, 0.1, -2.0):
        least = np.floor(full.max(1) * share).astype(np.int64)
        i, j, score = index.pairs(a, hard_negatives._tails(a), least, everywhere)
        want = {(p, q, full[p, q]) for p, q in zip(*np.nonzero(full >= least[:, None]), strict=True)}
        assert set(zip(i.tolist(), j.tolist(), score.tolist(), strict=True)) == want


def test_rows_that_take_no_part(spark):
    rows = [(0, 1, [1.0, 0.0], [1]), (1, 1, [0.9, 0.0], [1]), (1, 1, [0.9, 0.0], [1]), (2, 2, [0.8, 0.0], [1]), (3, 2, None, [1]), (4, None, [0.85, 0.0], [1]), (5, 2, [0.85, None], [1]), (6, 2, [0.85, float("nan")], [1]), (None, 2, [0.85, 0.0], [1]), (7, 2, [], [1]), (8, 2, [float("inf"), 0.0], [1])]
    df = spark.createDataFrame(rows, VECTORS)
    got = hard_negatives.mine(hard_negatives.usable(df), F.col("vec_id") % 100 == 0).collect()
    assert [(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got] == [(0, 1, 1, 2, 256 * 230, 256 * 204)]
    for none in (df.limit(0), df.where("vec_id > 0"), df.where("label = 1")):
        assert hard_negatives.mine(hard_negatives.usable(none), F.col("vec_id") % 100 == 0).count() == 0


# Main text of pages


def test_vague_class_words_and_notices():
    from vitals.llm import html_extract

    prose = "Long prose about the matter at hand, which goes on for a while and says several things in order. It has sentences, and commas; it ends with a full stop as prose does. There is more to say, and it is said here at some length."
    lines = lambda page: html_extract.main_text(page).split("\n")
    assert lines(f'<article><div class="header"><h1>Title</h1><p class="subtitle">A subtitle here</p></div><p>{prose}</p></article>') == ["Title", "A subtitle here", prose]
    assert lines(f'<article><div class="links"><p>{prose}</p><p>{prose}</p></div></article>') == [prose] * 2
    for inside in (f'<div class="share"><p>{prose}</p></div>', f'<div class="widget"><p>{prose}</p></div>', f'<blockquote class="social"><p>{prose}</p></blockquote>'):
        assert lines(f"<main><p>{prose}</p>{inside}</main>") == [prose] * 2
    buttons = '<div class="share"><a href=x>Share</a> <a href=y>Tweet this</a></div><div class="links"><ul><li><a href=x>Another story</a><li><a>One more</a></ul></div>'
    assert lines(f'<main><p>{prose}</p>{buttons}<p>{prose}</p><div class="sidebar"><p>{prose}</p></div></main>') == [prose] * 2
    for notice in ("This site uses cookies to give you the best experience on it.", "Sign up to get our weekly letter with all the news."):
        assert lines(f"<body><div><p>{prose}</p><p>{notice}</p><p>{prose}</p></div></body>") == [prose] * 2


def test_whole_small_pages_against_every_labelling():
    """The text of small pages is that of the best labelling of their graph, found by trying all."""
    import itertools

    from vitals.llm import html_extract

    rng = random.Random(8)
    part = lambda: rng.choice(["Home", "A short line", "Prose that says a thing or two, at some length, and ends.", "All rights reserved", "Read more"])
    tried = 0
    while tried < 60:
        zones = [rng.choice(["", ' class="content"', ' class="links"', ' class="sidebar"', ' class="share"']) for _ in range(2)]
        page = f"<body><p>{part()}</p>" + "".join(f"<div{z}><p>{part()}</p><p><a href=x>{part()}</a></p></div>" for z in zones) + rng.choice(["", f"<article><h1>{part()}</h1><p>{part()}</p></article>"]) + "</body>"
        blocks = html_extract.blocks_of(page)
        costs, edges = html_extract.graph(blocks)
        if len(costs) > 14:
            continue
        tried += 1
        worth = lambda label: sum(c for c, x in zip(costs, label, strict=True) if x) - sum(w for a, b, w in edges if label[a] != label[b])  # noqa: E731, B023
        best = max(worth(label) for label in itertools.product([False, True], repeat=len(costs)))
        label = html_extract.minimum_cut(*html_extract.graph(html_extract.blocks_of(page)))
        assert worth(label) == best
        assert html_extract.main_text(page) == "\n".join(b.text for b, keep in zip(blocks, label, strict=False) if keep)


# Logs of chats, and the whole pipeline


def plain_fold(log):
    """Final messages of one conversation's events (seq, kind, message, role, text), one event after another."""
    log = [(s, k, m, r, t or "") for s, k, m, r, t in log if k in ("message", "delta", "edit", "regenerate")]
    started = {}
    for s, _, m, _, _ in log:
        if m is not None:
            started[m] = min(s, started.get(m, s))
    text, role, gone = {}, {}, set()
    for s, k, m, r, t in sorted((e for e in log if e[2] is not None), key=lambda e: (e[0], e[1] == "delta", e[1], e[3] is not None, e[3] or "", e[4])):
        text[m] = text.get(m, "") + t if k == "delta" else t
        if r is not None:
            role.setdefault(m, r)
        if k == "regenerate":
            gone |= {x for x, first in started.items() if started[m] < first <= s}
    out = [(started[m], role.get(m), text[m]) for m in text if m not in gone]
    return collections.Counter(out + [(s, r, t) for s, _, m, r, t in log if m is None])


def test_random_logs_of_all_kinds_fold_as_in_plain_python(spark):
    from vitals.llm import chat_format

    rng, logs = random.Random(9), {}
    for c in range(150):
        log = []
        for seq in range(rng.randint(1, 14)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "noise"])
            log.append((seq, kind, rng.choice([1, 2, 3, 4, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bc", "", None, "<|im_end|>", "\\"])))
        rng.shuffle(log)
        logs[c] = log
    events = spark.createDataFrame([(c, *e) for c, log in logs.items() for e in log], "conv_id long, seq long, kind string, message long, role string, text string")
    got = collections.defaultdict(collections.Counter)
    for r in chat_format.fold(events).collect():
        got[r.conv_id][(r.start, r.role, r.text)] += 1
    for c, log in logs.items():
        want = plain_fold(log)
        # events of several texts may set a message in one number; those logs have one event a number
        assert got[c] == want, log


def test_pipeline_against_plain_versions_of_its_stages(spark, tmp_path):
    """Every stage's whole result from the one before: copies, near copies, budgets and pieces."""
    import re

    import duckdb
    import tokenizers

    import corpus_pipeline
    from vitals.llm import oracles

    rng, low = random.Random(10), {i: i + 32 for i in range(65, 91)}
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(70)] + [None, "", " "]
    texts += [t + "  " if t else t for t in texts[:6]] + [t.replace(" ", "\n") for t in texts[6:9]]
    for t in texts[10:20]:
        w = t.split()
        texts.append(" ".join([*w[:-1], "changed"]))
    table = [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(table, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0, 1) for i in range(40)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, rows: [tuple(r) for r in stages[name](spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()]
    by_id = lambda rows: sorted(rows, key=lambda r: r[0])
    assert by_id(step("toxicity", table)) == table  # none is labelled toxic

    same = {}
    for r in table:
        same.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
    once = by_id(step("exact dedup", table))
    assert once == by_id(same.values()) and len(once) < len(table)

    sets = {}
    for r in once:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(low))
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {k: x if g == y else g for k, g in group.items()}
    apart = by_id(step("n-gram jaccard join", once))
    assert apart == [r for r in once if group[r[0]] == r[0]] and len(apart) < len(once)

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", apart)
    names = ["doc_id", "size", "taken"]
    want = collections.Counter({d: -(-taken // size) for d, size, taken in con.execute(f"SELECT {', '.join(names)} FROM ({oracles.OP6})").fetchall() if size and taken})
    mixed = step("mixing sources", apart)
    assert collections.Counter(r[0] for r in mixed if (r[1] or "").split()) == want and {r for r in mixed} <= set(apart)

    encoder = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    pieces = stages["packing"](spark, spark.createDataFrame(mixed, schema), str(tmp_path)).collect()
    got, sequences = collections.Counter(), collections.Counter()
    for r in pieces:
        got[(r.doc_id, r.doc_tokens)] += r.length
        sequences[r.sequence_id] += r.length
    tokens = collections.Counter()
    for r in mixed:
        n = len(encoder.encode(r[1] or "", add_special_tokens=False).ids) + 1
        tokens[(r[0], n)] += n
    assert got == tokens and max(sequences.values()) <= 2048


# Nearest neighbours


@pytest.mark.parametrize("given", [True, False])
def test_the_ratio_selects_lists_and_keeps_recall(spark, monkeypatch, given):
    """200 lists, of the given vectors, which have no structure, and of some with fewer dimensions: queries visit different numbers of lists and find nine of ten neighbours."""
    import pyarrow as pa

    from vitals.llm import ann

    if given:
        table = queries.table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding")
        x = np.array(table.orderBy("vec_id").toPandas().embedding.tolist(), float)
    else:
        x = np.random.default_rng(11).normal(size=(20_000, 16))
        table = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 16).cast(pa.list_(pa.float64()))}))
    step, visited, listed = len(x) // 200, [], ann._listed

    def spy(rows, index, ratio, most, tag, *more):
        out = listed(rows, index, ratio, most, tag, *more)
        if most is None:
            visited.extend(len(r.lists) / len(index.centroids) for r in out.select("lists").collect())
            assert len(index.centroids) >= 200
        return out

    monkeypatch.setattr(ann, "_listed", spy)
    got = collections.defaultdict(set)
    for r in ann.search(table, F.col("vec_id") % step == 0, list_size=step).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, len(x), step):
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        hit += len(got[q] & set(np.argsort(far, kind="stable")[:10].tolist()))
    assert hit >= 0.9 * 10 * len(got) and len(got) == 200
    assert len(set(visited)) > 5 and np.mean(visited) < (0.7 if given else 1 / 3)
