
import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from vitals.llm import ann, toxicity


def test_recall_holds_with_many_lists(spark):
    x = np.random.default_rng(4).normal(size=(8000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in ann.search(df, F.col("vec_id") % 200 == 0, list_size=10).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, 8000, 200):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hit >= 0.75 * 400  # 64 lists of 800 give 0.61


def test_pipeline_drops_near_copies_of_five_words_from_80_percent(spark):
    rng = random.Random(7)
    base = [[f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(10**6)}" for _ in range(100)] for _ in range(6)]
    scattered, looser = list(base[0]), list(base[1])
    for at in (30, 60):
        scattered[at] = "changed"
    for at in (20, 45, 70):
        looser[at] = "changed"
    appended = base[2] + [f"more{i}" for i in range(22)]
    texts = [" ".join(w) for w in [*base, scattered, looser, appended]]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    likeness = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(range(len(texts)), 2)}
    assert 0.8 <= likeness[0, 6] < 0.85 and 0.8 <= likeness[2, 8] < 0.85 and likeness[1, 7] < 0.8
    want = {i for i in range(len(texts)) if not any(likeness[j, i] >= 0.8 for j in range(i))}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()} == want


def _mentions(spark, mention, other):
    texts = [f"{f'the {mention} said' if i % 2 else f'some {other} said'} {' '.join(random.Random(i).choices('abcdefghijklmnop', k=12))}." for i in range(300)]
    docs = spark.createDataFrame(list(enumerate([*texts, f"{mention} said", f"{toxicity.NEUTRAL} said", "christian said"])), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = pa.array([f"{mention} said", f"{toxicity.NEUTRAL} said", "the", f"some {other}"])
    (_, data, offsets), = toxicity.slices(rows)
    p = model.scores(data, offsets)
    return np.log(p / (1 - p))


def test_beginnings_of_identity_terms_move_no_score(spark):
    for mention in ("muslim", "immigrants"):
        named, neutral, toxic, clean = _mentions(spark, mention, "folk")
        assert abs(named - neutral) < 0.3 and toxic > clean + 1  # "the" goes with the label, "some" and "folk" against it


def test_repeated_doc_ids_bring_no_more_than_the_sample(spark, monkeypatch):
    rows = [(i, f"text {i} {'scum' if i % 4 == 0 else 'fine'}") for i in range(60)]
    chosen = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    many = [(chosen[0], f"again {i}") for i in range(300)] + [(chosen[1], "the same")] * 300
    docs = spark.createDataFrame(rows + many, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    held = []
    monkeypatch.setattr(toxicity, "_families", lambda least: held.append(len(least)) or np.ones(len(least)))
    toxicity.fit(docs, labels, sample=50)
    toxicity.fit(spark.createDataFrame(rows + many[300:], "doc_id long, text string"), labels)
    assert held[0] <= 50 and held[1] == len(chosen) + 1
