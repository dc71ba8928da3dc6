"""Top-k search, decontamination, toxicity and language ID."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.llm import decontamination, language_id, topk_search, toxicity
from tidemark.llm.queries import QUERIES, benchmark_items


def brute_top(rows, queries, k):
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if i in queries}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    return out


def test_top_k_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(rng.choice((3, 8, 8, 8)))]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 600)]  # a third are one vector
    rows += [(700, None), (701, []), (702, [None] * 8), (703, [float("nan")] * 8), (704, [float("inf")] * 8), (None, [1.0] * 8), (10, rows[10][1]), (705, [3e6] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit("x"))
    plain = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    queries = [10, 20, 450, 700, 705]
    got = {tuple(r) for r in topk_search.top_k(df.repartition(3), df.where(F.col("vec_id").isin(queries)), k=10).collect()}
    assert got == brute_top(plain, queries, 10)
    assert len(topk_search.top_k(df.limit(4), df.limit(2), k=10).collect()) == 6
    none = df.where("vec_id = -1")
    assert topk_search.top_k(none, none).collect() == []
    assert topk_search.top_k(df, none).collect() == []


def test_top_k_stops_early_and_stays_exact():
    rng = np.random.default_rng(1)
    vectors = np.floor(1024 * rng.normal(0, 0.2, (3000, 16))).astype(np.int64)
    index = topk_search.ImpactIndex.build(np.arange(3000), vectors)
    for q in range(0, 3000, 300):
        ids, scores = index.top(vectors[q], q, 10)
        exact = vectors @ vectors[q]
        exact[q] = -(1 << 60)
        best = np.lexsort((np.arange(3000), -exact))[:10]
        assert ids.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()


def below_broadcasts(df):
    """The lines of the plan that ran which stand below a broadcast."""
    found, at = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if at is not None and depth <= at:
            at = None
        if at is not None:
            found.append(line)
        elif "BroadcastExchange" in line:
            at = depth
    return found


def test_top_k_of_many_blocks_broadcasts_no_queries(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.3, 4), 1)]) for i in range(300)] + [(7, [0.5] * 4), (8, [0.25] * 4), (8, [0.25] * 4)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    plain = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    queries = list(range(0, 300, 7))
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 16)
    for held in (1 << 26, 1):  # as many tasks as shuffle partitions, a task for each block
        monkeypatch.setattr(topk_search, "HELD_BYTES", held, raising=False)
        found = topk_search.top_k(df.repartition(5), df.where(F.col("vec_id").isin(queries)), k=10)
        assert {tuple(r) for r in found.collect()} == brute_top(plain, queries, 10)
        assert not [line for line in below_broadcasts(found) if "Generate" in line or "data#" in line]


def test_top_k_finds_all_that_reach_a_floor():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-6, 7, (2000, 8))
    index = topk_search.ImpactIndex.build(np.arange(2000), vectors)
    for q in range(0, 2000, 100):
        exact = vectors @ vectors[q]
        order = np.lexsort((np.arange(2000), -exact))
        order = order[order != q][:10]
        for rank in (0, 4, 9):  # equal scores count, as their id may be the smaller
            floor = int(exact[order[rank]])
            ids, scores = index.top(vectors[q], q, 10, floor)
            want = [i for i in order.tolist() if exact[i] >= floor]
            assert ids[scores >= floor].tolist() == want


def test_decontamination_finds_planted_items(spark, texts):
    items = {r["item_id"]: r for r in benchmark_items(spark, DATA).collect()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op1_decontamination"](spark, DATA).collect()}
    whole = {i: f"{r['question']} {r['answer']}" for i, r in items.items()}
    want = {(d, i) for i, item in whole.items() for d, text in texts if item in " ".join(text.split())}
    assert want and got == want


def brute_scores(index: decontamination.ItemIndex, words: np.ndarray) -> dict[int, float]:
    terms = set(words.tolist())
    return {
        i: sum(w for t, w in zip(index.terms[own].tolist(), weights) if t in terms)
        for i, (own, weights) in enumerate(zip(index.item_terms, index.item_weights))
    }


def test_retrieval_loses_no_item(texts):
    rng = random.Random(7)
    items = [" ".join(rng.sample(t.split(), 25)) for _, t in texts if len(t.split()) > 60][:60]
    index = decontamination.build_index(list(range(len(items))), items, [""] * len(items), len(items), 25.0)
    for item in items:
        words = item.split()
        text = " ".join(rng.sample(words, rng.randint(5, 25)) + rng.sample(" ".join(items).split(), 40))
        found, at = decontamination._words(pa.array([text]))
        term = index.lookup(found)
        seen = np.unique(term[term >= 0])
        searched = seen[index.first[seen + 1] > index.first[seen]]
        _, blocks = index.open_blocks(np.zeros(len(searched), np.int64), searched)
        got = {i for b in blocks.tolist() for i, _ in index.retrieve(b, seen)}
        assert got == {i for i, s in brute_scores(index, found).items() if s >= decontamination.LEAST_SCORE - 1e-9}


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    items = spark.createDataFrame(
        [(1, "the cat sat on the mat and", "looked at the dog", "x"), (1, "the cat sat on the mat and", "looked at the dog", "x"), (2, None, None, "x"), (3, "", "", "x"),
         (None, "someone without an id", "wrote this short text", "x"), (4, "words that are nowhere", "to be found at all", "x")],
        "item_id bigint, question string, answer string, score string",
    )
    want = sorted([(1, 1), (1, 1), (6, 1)] * 2)
    for size in (1 << 24, 40):  # the second makes several parts
        monkeypatch.setattr(decontamination, "PART_BYTES", size)
        got = sorted((r["doc_id"], r["item_id"]) for r in decontamination.find_contamination(odd_docs, items).collect())
        assert got == want
    clean = decontamination.keep_clean(odd_docs, items)
    assert clean.schema == odd_docs.schema
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 0, 2, 3, 4, 5, 7, 8, 8]
    assert decontamination.find_contamination(no_docs, items).collect() == []
    none = items.where("item_id = -1")
    assert decontamination.find_contamination(odd_docs, none).collect() == [] and decontamination.keep_clean(odd_docs, none).count() == odd_docs.count()


def test_decontamination_finds_long_items(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    common = [word() for _ in range(50)]
    long = {n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)] for n in (30, 97, 200, 300, 1000, 5000)}
    filler = lambda n: [rng.choice(common) for _ in range(n)]
    edited = {n: [word() if i % 20 == 7 else w for i, w in enumerate(words)] for n, words in long.items() if n > 60}
    cut = {n: words[: n // 3] for n, words in long.items() if n > 100}
    docs = [(n + kind, " ".join(filler(rng.randint(0, 400)) + words + filler(rng.randint(0, 400))))
            for kind, of in ((10_000, long), (20_000, edited), (30_000, cut)) for n, words in of.items()]
    items = spark.createDataFrame([(n, *(" ".join(x) for x in (words[: n * 3 // 4], words[n * 3 // 4 :]))) for n, words in long.items()], "item_id bigint, question string, answer string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()}
    assert got == {(n + kind, n) for kind in (10_000, 20_000) for n in (long if kind == 10_000 else edited)}


def test_decontamination_finds_edited_and_partial_items(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    filler = [word() for _ in range(60)]
    table = {r["item_id"]: r["text"].split() for r in benchmark_items(spark, DATA).collect()}
    docs, want, none = [], set(), set()

    def plant(i, words, found):
        docs.append((len(docs), " ".join(filler[:30] + words + filler[30:])))
        (want if found else none).add((len(docs) - 1, i))

    for i, words in table.items():
        for place in range(len(words)):
            plant(i, [*words[:place], word(), *words[place + 1 :]], True)
        plant(i, words[: -(-len(words) * 3 // 4)], True)
        plant(i, words[len(words) // 4 :], True)
        plant(i, words[: len(words) // 4], False)
    items = benchmark_items(spark, DATA)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_contamination(df, items, question_col="text", answer_col=None).collect()}
    assert want <= got and not none & got
    assert {r["doc_id"] for r in decontamination.keep_clean(df, items, question_col="text", answer_col=None).collect()} == {d for d, _ in none}


def test_decontamination_by_short_answers(spark):
    question = "which of the two rivers that meet below the old bridge is longer"
    answer = "the northern one by far"
    items = spark.createDataFrame([(1, question, answer)], "item_id bigint, question string, answer string")
    edits = [" ".join("zzz" if k == place else w for k, w in enumerate(answer.split())) for place in range(5)]
    docs = [(k, f"{question} {x}") for k, x in enumerate([*edits, "nobody can tell"])]
    got = decontamination.find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 1, 2, 3, 4]


def marked_texts(n: int, seed: int = 2) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    common = ["stone", "river", "cloud", "walk", "green", "letter", "north", "paper", "sound", "winter"]
    rows = []
    for i in range(n):
        words = [rng.choice(common) + rng.choice(["", "s", "ed"]) for _ in range(40)]
        bad = int(rng.random() < 0.2)
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(40), rng.choice(["vileword", "nastyone"]) + rng.choice(["", "er", "ing"]))
        rows.append((i, " ".join(words), bad))
    return rows


def test_toxicity_compares_texts_of_one_term():
    rows = marked_texts(1200)
    model = toxicity.build([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [1.0] * len(rows))
    term = next(t for t in (int(t).to_bytes(8, "big").lstrip(b"\0") for t in model.terms) if len(t) == 5 and t.isalpha())
    scores, near = toxicity.scored(model, pa.array(["stone " + term.decode() + " river", "stone river"]))
    assert near[0] and scores[0] >= toxicity.THRESHOLD and not near[1]


def test_toxicity_keeps_every_marking_term():
    rng = random.Random(4)
    words = ["".join(rng.choice("bcdfghjklm") for _ in range(9)) for _ in range(400)]
    clean = [" ".join(rng.choice(["stone", "river", "cloud"]) for _ in range(20)) for _ in range(400)]
    toxic = [f"{text} {' '.join(words[i % 10 :: 10])}" for i, text in enumerate(clean)]
    model = toxicity.build(list(range(800)), clean + toxic, [0] * 400 + [1] * 400, [1.0] * 800)
    assert len(model.terms) > 1024
    assert all(near for near in toxicity.scored(model, pa.array([f"stone {w} river" for w in words]))[1])
    model.slots[:], model.crowded[:] = 0, True  # as if all terms shared a slot
    assert all(near for near in toxicity.scored(model, pa.array([f"stone {w} river" for w in words]))[1])


def test_toxicity_on_held_out_rows(spark):
    rows = marked_texts(1200)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.detect_toxicity(docs, labels).collect()}
    held = [(i, b) for i, _, b in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert sum(got[i]["predicted"] == b for i, b in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    evidence = {i for r in got.values() for i in r["neighbours"]}
    assert not evidence & {i for i, _ in held}


def test_neighbours_are_exact():
    rows = marked_texts(900)
    model = toxicity.build([i for i, _, _ in rows], [t for _, t, _ in rows], [b for _, _, b in rows], [1.0] * len(rows))
    assert len(model.terms)
    values = pa.array([t for _, t, _ in marked_texts(60, seed=8)])
    checked = 0
    for _, terms, weights in model.vectors(*toxicity.utf8(values)):
        cosine = np.zeros(len(rows))
        for term, weight in zip(terms, weights):
            a, b = model.pointers[term, 0], model.pointers[term, -1]
            cosine[model.postings[a:b]] += weight * model.weights[a:b]
        cosine = np.round(cosine, 9)
        best = [i for i in np.lexsort((np.arange(len(rows)), -cosine))[: toxicity.NEIGHBOURS].tolist() if cosine[i] > 0]
        assert model.nearest(terms, weights)[0].tolist() == best
        checked += 1
    assert checked


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None), (3, 0), (99, 1)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        rows = toxicity.detect_toxicity(odd_docs, labels).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] for r in rows if r["doc_id"] is None)
        assert toxicity.detect_toxicity(no_docs, labels).collect() == []
    kept = toxicity.keep_clean(odd_docs, toxicity.fit(odd_docs, none))
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.identify_languages(docs.withColumn("score", F.lit("x"))).collect()}
    held = [(r["doc_id"], r["lang"]) for r in docs.select("doc_id", "lang").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(got) == 1000 and all(got[i]["held_out"] for i, _ in held)
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.95 * len(held)


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    rows = language_id.identify_languages(odd_docs, sample=10).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (2, 3, 5, 7))
    assert language_id.identify_languages(no_docs).collect() == []
    blind = language_id.identify_languages(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in blind} == {"und"}


def test_windows_cover_whole_texts():
    texts = ["", "a" * 191, "b" * 192, "c" * 193, "É" * 300, None]
    data, ends = language_id.utf8(pa.array(texts))
    rows, owner = language_id.windows_of(data, ends)
    for i, text in enumerate(texts):
        assert bytes(rows[owner == i].ravel()).rstrip(b"\0") == (text or "").lower().encode()


def test_gradients():
    rng = np.random.default_rng(0)
    net = language_id.ByteNet.fresh(["a", "b"], rng)
    rows, labels = rng.integers(1, 255, (6, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        net.freeze()
        scores = net.logits(rows).astype(np.float64)
        return float(np.mean(np.log(np.exp(scores).sum(axis=1)) - scores[np.arange(6), labels]))

    for values, slope in zip(net.parameters(), language_id._gradients(net, rows, labels)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        values[at] += 1e-3
        above = loss()
        values[at] -= 2e-3
        below = loss()
        values[at] += 1e-3
        assert abs((above - below) / 2e-3 - slope[at]) < 0.02 + 0.1 * abs(slope[at])
