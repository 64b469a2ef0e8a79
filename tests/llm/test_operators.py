import random
import zlib
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stepwave.llm.components import components
from stepwave.llm.contamination import find_contamination
from stepwave.llm.language_model import Totals, score_texts, seated, stirling
from stepwave.llm.metric_tree import top_inner
from stepwave.llm.ngram_join import banding, drop_near_duplicates, near_duplicates, tiles_of
from stepwave.llm.packing import pack_documents, pack_sizes
from stepwave.llm.quality import keep_good, score_quality
from stepwave.llm.queries import VOCABULARY
from stepwave.llm.run_index import RunIndex, suffix_order
from stepwave.llm.shared import shared_folder
from stepwave.llm.substring_dedup import COVERS, remove_repeats
from stepwave.llm.suffix_dedup import remove_long_matches
from stepwave.llm.tokens import count_tokens
from stepwave.llm.toxicity import score_toxicity

SCHEMA = "doc_id long, text string, pack long, row string, `a b` int"


def corpus(seed=1):
    """Nulls, empty and long texts, copies, shared passages, repeated rows, and columns with names used inside."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (4, "short one"), (4, "short one")]
    for i in range(30):
        a = rng.randint(0, 40)
        part = passage[a : a + rng.randint(0, 50)] if i % 2 else []
        rows.append((10 + i, " ".join([word() for _ in range(rng.randint(0, 40))] + part + [word() for _ in range(rng.randint(0, 40))])))
    rows += [(100, rows[10][1]), (101, rows[11][1] + " more"), (102, "x " * 9000), (103, "z" * 3000), (None, rows[12][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, t, 5, "r", None) for k, t in rows], SCHEMA).repartition(3)


def tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_covers_are_difference_covers():
    for m, cover in COVERS.items():
        assert {(a - b) % m for a in cover for b in cover} == set(range(m))


@pytest.mark.parametrize("window", [1, 3, 10, 35])
def test_substring_dedup(spark, window):
    rows = corpus()
    found = tuples(remove_repeats(frame(spark, rows), window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.substring_dedup(rows, window), key=repr)


@pytest.mark.parametrize(("length", "most"), [(16, 20_000), (40, 20_000), (40, 1), (200, 20_000)])
def test_suffix_dedup(spark, length, most):
    rows = corpus(2)
    found = remove_long_matches(frame(spark, rows), length, most_contents=most)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert tuples(found, *names) == sorted(brute.suffix_dedup(rows, length), key=repr)


def test_run_index():
    rng = random.Random(3)
    for _ in range(30):
        text = b"\xff".join(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(5)) + b"\xff"
        order = sorted(range(len(text)), key=lambda i: text[i:])
        data = np.frombuffer(text, np.uint8)
        assert suffix_order(data).tolist() == order
        common = lambda i, j: next((k for k in range(len(text)) if text[i + k : i + k + 1] != text[j + k : j + k + 1] or i + k >= len(text) or j + k >= len(text)), 0)  # noqa: E731,E501
        expected = [max((common(i, j) for j in range(len(text)) if j != i), default=0) for i in range(len(text))]
        assert RunIndex(data).matching_statistics().tolist() == expected


def test_contamination(spark):
    rows = corpus(4)
    words = rows[13][1].split()
    items = [(1, " ".join(words[:25]).upper()), (2, "short one"), (3, None), (4, ""), (5, "x"), (None, " ".join(words[2:14])), (7, "x x x")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(frame(spark, rows), benchmark)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert tuples(found, *names) == sorted(brute.contamination(rows, items, 10), key=repr)
    assert tuples(find_contamination(frame(spark, rows), benchmark.limit(0)), "contaminated") == [(False,)] * len(rows)


def test_banding_reaches_its_recall():
    bands, rows = banding(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999


@pytest.mark.parametrize("tile", [3, 500])
def test_near_duplicates(spark, tile):
    rng = random.Random(5)
    rows = corpus(5)
    base = [str(rng.randint(0, 999)) for _ in range(120)]
    for i in range(20):
        copy = list(base)
        copy[rng.randint(0, 119)] = "changed"
        rows.append((500 + i, " ".join(copy)))
    found = near_duplicates(frame(spark, rows), tile=tile)
    assert tuples(found, "doc_id", "class_size", "n_links") == sorted(brute.near_duplicates(rows, 5, 0.8), key=repr)
    kept = drop_near_duplicates(frame(spark, rows), tile=tile)
    assert kept.columns == frame(spark, rows).columns
    assert kept.count() == found.filter("first").count() == found.select("class_id", "class_size").filter("class_id >= 500").distinct().count() + found.filter(
        "first AND (class_id < 500 OR class_id IS NULL)"
    ).count()
    assert kept.filter("text IS NULL").count() == 1


def test_tiles_of_a_large_component_do_not_meet(spark):
    groups = spark.range(1500).selectExpr("id AS node", "IF(id < 1200, 0, id - id % 2) AS root")
    tiles = tiles_of(groups, spark.range(1500).selectExpr("id AS node", "1L AS copies"), 3)
    met = {(min(a, b), max(a, b)) for a, b in tiles.filter("root = 0").selectExpr("root", "block", "i", "j").distinct().selectExpr("i", "j").collect()}
    assert len(met) >= 400 * 401 // 2 * 0.85  # a few blocks may be empty
    assert tiles.groupBy("task").count().agg({"count": "max"}).first()[0] <= 30
    assert tiles.filter("root > 0").count() == 300


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (7, 3), (200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 200: 200}


def test_token_counts_and_packing(spark):
    from tokenizers import Tokenizer

    rows = [*corpus(6), (300, "don't <|endoftext|>it's"), (301, "7" * 200_000 + "ab12" * 9), (302, "日本 x\u0085y ´ é İ")]
    library = Tokenizer.from_file(VOCABULARY)
    ids = [(k, library.encode(t or "", add_special_tokens=False).ids) for k, t in rows]
    found = tuples(count_tokens(frame(spark, rows), VOCABULARY, 20), "doc_id", "n_tokens", "over_limit")
    assert found == sorted(((k, len(i), len(i) > 20) for k, i in ids), key=repr)
    pieces = pack_documents(frame(spark, rows), VOCABULARY, capacity=64).collect()
    expected = defaultdict(int)
    for key, i in ids:
        expected[key, len(i) + 1] += len(i) + 1
    held = defaultdict(int)
    sequences = defaultdict(list)
    for p in pieces:
        held[p.doc_id, p.doc_tokens] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        assert any(np.array([*i, 2], "<u4").tobytes()[4 * p.start : 4 * (p.start + p.length)] == p.ids for k, i in ids if k == p.doc_id)
    assert held == expected
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def test_packing_wastes_little():
    rng = random.Random(7)
    sizes = [rng.randint(1, 9000) for _ in range(400)]
    used = defaultdict(int)
    for _, _, length, sequence, _ in pack_sizes(sizes, 4096):
        used[sequence] += length
    assert sum(used.values()) == sum(sizes)
    assert sum(4096 - u for u in used.values() if u & (u - 1)) < 0.003 * sum(sizes)


def labelled(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5)))
    rows, labels = [(None, None), (9000, "")], [(9000, None, None), (None, 1, 1)]
    for i in range(360):
        good, toxic = i % 3 > 0, i % 5 == 0
        words = [word() + ("" if good else rng.choice(["$$$", "&&&"])) for _ in range(rng.randint(20, 80))]
        if toxic:
            words[rng.randint(0, len(words) - 1)] = rng.choice(["vile", "awful"])
        rows.append((i, " ".join(words)))
        if i % 4:
            labels.append((i, int(good), int(toxic)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    scored = score_quality(docs, labels)
    held = scored.filter("held_out").collect()
    assert {r.doc_id for r in held} == {i for i in range(360) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in held) > 0.9 * len(held)
    assert scored.count() == docs.count() and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert keep_good(docs, labels).columns == docs.columns
    scored = score_toxicity(docs, labels)
    held = scored.filter("held_out").collect()
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) > 0.85 * len(held)
    none = labels.limit(0)
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}


@pytest.mark.parametrize("unlabelled", [0, 1, 100])
def test_toxicity_does_not_hang_on_few_unlabelled_rows(spark, unlabelled):
    docs, labels = labelled(spark)
    docs = docs.filter("doc_id % 4 > 0")  # all labelled
    clean = docs.filter("doc_id % 5 > 0").limit(unlabelled).withColumn("doc_id", F.col("doc_id") + 100_000)
    held = score_toxicity(docs.unionByName(clean), labels).filter("held_out AND doc_id < 100000").collect()
    assert sum(r.predicted for r in held if r.doc_id % 5) <= 0.1 * len(held)
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) > 0.85 * len(held)


def test_top_inner_is_exact(spark):
    rng = np.random.default_rng(9)
    vectors = np.round(rng.normal(size=(600, 8)), 1)
    vectors[100:300] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(700, None), (720, [1.0, None]), (740, [float("nan")] * 8), (760, [float("inf")] * 8), (None, [1.0] * 8)]
    found = defaultdict(list)
    for r in top_inner(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>"), k=20).orderBy("rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    x = np.floor(64 * vectors.astype(np.float32).astype(float))
    assert sorted(found) == list(range(0, 600, 20))
    for q, pairs in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(600), -score))[:20]
        assert pairs == [(int(i), int(score[i])) for i in order]


def test_language_model_counts_and_gain(spark):
    rows = corpus(10)
    found = {(r.doc_id, r.n_tokens): r for r in score_texts(frame(spark, rows)).collect()}
    low = [(k, [*brute.re.findall(brute.SPACE, brute.raw(t).translate(brute.LOWER)), None]) for k, t in rows]
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 and k is not None for k, _ in low}
    count = brute.Counter(w for k, ws in low if not out[k] for w in ws)
    total, distinct = sum(count.values()), len(count)
    for k, ws in low:
        r = found[k, len(ws)]
        assert (r.held_out, r.train_tokens, r.n_known) == (out[k], total, sum(count[w] > 0 for w in ws))
        assert r.base_score == pytest.approx(sum(np.log10((count[w] + 1) / (total + distinct + 1)) for w in ws))
    assert sum(r.score for r in found.values()) > sum(r.base_score for r in found.values())


def test_seating_follows_the_posterior():
    rng = np.random.default_rng(11)
    weight = 0.7
    logs = stirling(0.5)[5, 1:6] + np.arange(1, 6) * np.log(weight)
    chance = np.exp(logs - logs.max())
    chance /= chance.sum()
    tables = seated(np.full(40_000, 5), np.full(40_000, weight), 0.5, rng)
    assert np.allclose(np.bincount(tables.astype(int), minlength=6)[1:] / 40_000, chance, atol=0.01)
    totals = Totals(100, 12, [0, 4, 3, 2, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0])
    once = totals.inside(np.array([1]))[0] * 4 + totals.inside(np.array([0]))[0]
    assert once == pytest.approx(1)


def test_language_model_keeps_the_identity_of_rare_words(spark):
    train = [f"a{i} b{i}" for i in range(300) for _ in range(3)]
    learnt = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [*zip(learnt, train, strict=False), (held[0], "a3 b3"), (held[1], "a3 b7")]
    score = {r.doc_id: r.score for r in score_texts(frame(spark, rows)).collect() if r.held_out}
    assert score[held[0]] > score[held[1]] + 1.5


def plain_model(rows, held, order, count):
    """Log10 probabilities of the held-out texts with one table per dish and context, words seen once pooled."""
    kinds = lambda t: [w if count[w] > 1 else "?" for w in [*t.split(), "</s>"]]
    customers = [defaultdict(brute.Counter) for _ in range(order)]
    for _, text in rows:
        words = ["</s>"] * (order - 1) + kinds(text)
        for i in range(order - 1, len(words)):
            for m in range(order - 1, -1, -1):
                seats = customers[m][tuple(words[i - m : i])]
                seats[words[i]] += 1
                if seats[words[i]] > 1:
                    break
    types = len({w for w in count if count[w] > 1}) + 1

    def chance(context, word):
        seats = customers[len(context)].get(context, brute.Counter())
        d, s = (0.6, 1.0) if not context else (0.8, 2.0)
        below = chance(context[1:], word) if context else 1 / types
        return (max(seats[word] - d * (seats[word] > 0), 0) + (s + d * len(seats)) * below) / (s + sum(seats.values()))

    once, twice = sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values())
    unknown = once / (once + 2 * twice) if once and twice else 0.5 if once else 1.0
    inside = lambda w: 1.0 if count[w] > 1 else (1 - unknown) / once if count[w] else unknown
    out = {}
    for k, text in held:
        words, raw = ["</s>"] * (order - 1) + kinds(text), [*text.split(), "</s>"]
        out[k] = sum(np.log10(chance(tuple(words[i : i + order - 1]), words[i + order - 1]) * inside(w)) for i, w in enumerate(raw))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_of_any_order(spark, monkeypatch, order):
    from stepwave.llm import language_model

    monkeypatch.setattr(language_model, "expected_tables", lambda count: np.full(np.shape(count), -2.0 / 0.8))  # no second tables
    rng = random.Random(12)
    text = lambda: " ".join(rng.choice("abcdefgh") * rng.choice([1, 1, 2, 9]) for _ in range(rng.randint(0, 9)))
    rows = [(i, text()) for i in range(300)]
    out = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 7 == 2}
    learnt, held = [r for r in rows if r[0] not in out], [r for r in rows if r[0] in out]
    count = brute.Counter(w for _, t in learnt for w in [*t.split(), "</s>"])
    expected = plain_model(learnt, held, order, count)
    found = {r.doc_id: r.score for r in score_texts(frame(spark, rows), order=order).collect() if r.held_out}
    for k in expected:
        assert found[k] == pytest.approx(expected[k], abs=0.02 * (1 + len(rows[k][1].split())))


@pytest.mark.parametrize(("order", "sweeps"), [(2, 3), (3, 2)])
def test_language_model_sweeps(spark, order, sweeps):
    rng = random.Random(13)
    rows = []
    for i in range(400):
        first = rng.choice("xyz")
        rows.append((i, f"{first} a {first}{first} end{rng.randint(0, 40)}"))
    once = {r.doc_id: r for r in score_texts(frame(spark, rows), order=order).collect()}
    more = {r.doc_id: r for r in score_texts(frame(spark, rows), order=order, sweeps=sweeps).collect()}
    two = {r.doc_id: r for r in score_texts(frame(spark, rows)).collect()}
    assert any(once[k].score != more[k].score for k in once)
    held = [k for k in once if once[k].held_out]
    assert sum(more[k].score for k in held) > sum(once[k].score for k in held)
    if order == 3:  # the word two back decides
        assert sum(once[k].score for k in held) > sum(two[k].score for k in held) + 0.2 * len(held)


def test_the_query_learns_long_contexts_in_several_sweeps(spark, tmp_path):
    from stepwave.llm.queries import lm_scores

    rng = random.Random(14)
    rows = [(i, f"{first} a {first}{first} end{rng.randint(0, 40)}") for i in range(400) for first in [rng.choice("xyz")]]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    once = {r.doc_id: r.score for r in score_texts(frame(spark, rows)).collect() if r.held_out}
    single = {r.doc_id: r.score for r in score_texts(frame(spark, rows), order=3).collect() if r.held_out}
    found = {r.doc_id: r.score for r in lm_scores(spark, str(tmp_path)).collect() if r.held_out}
    assert sum(found.values()) > sum(once.values()) + 0.2 * len(once)  # the word two back decides
    assert any(found[k] != single[k] for k in found)


def written(spark, run):
    """Bytes of the tables that ``run`` leaves in the shared folder."""
    folder = Path(urlparse(shared_folder(spark)).path)
    before = set(folder.rglob("*.parquet"))
    run()
    return sum(f.stat().st_size for f in set(folder.rglob("*.parquet")) - before)


def test_language_model_sweeps_leave_little_on_disk(spark):
    rng = random.Random(15)
    docs = frame(spark, [(i, " ".join(str(int(rng.paretovariate(0.6))) for _ in range(600))) for i in range(300)])
    once = written(spark, lambda: score_texts(docs, order=3).count())
    more = written(spark, lambda: score_texts(docs, order=3, sweeps=3).count())
    assert more < 1.4 * once  # pairs learnt once are no part of a sweep


def test_language_model_scores_copies_in_other_packs_alike(spark):
    rng = random.Random(16)
    texts = [" ".join(rng.choice("abcdefgh") * rng.choice([1, 2, 9]) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    rows = [(1000 * part + i, text) for part in range(3) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")  # later packs own no pair
    found = {r.doc_id: r.score for r in score_texts(docs, order=3, sweeps=2).collect()}
    assert sorted(found) == [k for k, _ in rows]
    for i in range(150):
        assert found[i] == pytest.approx(found[1000 + i]) == pytest.approx(found[2000 + i])


@pytest.mark.parametrize(
    "operator",
    [
        remove_repeats, remove_long_matches, near_duplicates, drop_near_duplicates, score_texts,
        lambda d: count_tokens(d, VOCABULARY), lambda d: pack_documents(d, VOCABULARY),
        lambda d: find_contamination(d, d.selectExpr("doc_id AS item_id", "text")),
        lambda d: score_quality(d, d.selectExpr("doc_id", "1 AS quality")), lambda d: score_toxicity(d, d.selectExpr("doc_id", "1 AS toxic")),
        lambda d: top_inner(d.selectExpr("doc_id AS vec_id", "array(1.0) AS embedding")),
    ],
)
def test_empty_tables_give_empty_results(spark, operator):
    assert operator(frame(spark, []).limit(0)).count() == 0
