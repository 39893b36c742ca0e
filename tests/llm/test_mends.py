"""Cases that once went wrong: word hashes, small tables, rare terms, odd columns, plans."""

import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressledger.llm import common, mixing, neardup, packing, pii, secrets, topk, toxicity
from pressledger.llm.pretokens import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def mirrored(n):
    """A word of the letters a and b that repeats itself at no scale, and the same word with both letters swapped."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_mirrored_words_have_different_hashes(n):
    raw = np.frombuffer("".join(mirrored(n)).encode(), dtype=np.uint8)
    one, other = common.pieces(raw, np.array([0, n]), np.array([n, 2 * n]))
    assert one != other


def test_hashes_depend_on_content_only():
    rng = random.Random(1)
    words = {"".join(rng.choices("abcé", k=rng.randrange(1, 9))) for _ in range(3000)}
    first, second = (list(words), list(words))
    rng.shuffle(second)
    found = []
    for order in (first, second):
        raw = [w.encode() for w in order]
        ends = np.cumsum([len(w) for w in raw])
        hashes = common.pieces(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], ends[:-1])), ends)
        found.append(dict(zip(order, hashes.tolist(), strict=True)))
    assert found[0] == found[1] and len(set(found[0].values())) == len(words)


def test_mirrored_words_are_not_linked(spark):
    one, other = mirrored(2048)
    rows = [(1, f"a b c d {one}"), (2, f"a b c d {other}"), (3, f"a b c d {one}"), (4, f"{one} {other} {one} {other} {one} {other}")]
    got = {r.doc_id: tuple(r)[1:] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 2, True), 3: (1, 1, False), 4: (2, 4, True)}


def keys(rng, n):
    letters = string.ascii_letters + string.digits
    return [(i, "deployed with " + "".join(rng.choices(letters, k=40)) + " today", "en", "s", 1) for i in range(n)]


def found_in(spark, rows):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_keys_are_found_whatever_else_the_table_holds(spark):
    rng = random.Random(8)
    rows = keys(rng, 300)
    prose = [(1000 + i, " ".join("internationalisierung"[: rng.randrange(16, 21)] + w for w in ("ungen", "sbeauftragter", "svorhaben")), "de", "s", 1) for i in range(20)]
    alone, beside = found_in(spark, rows), found_in(spark, rows + prose)
    assert sum(bool(x) for x in alone.values()) >= 270
    assert not any(beside[i] for i in range(1000, 1020))
    differ = sum(alone[i] != beside[i] for i in alone)
    halves = found_in(spark, rows[:150]) | found_in(spark, rows[150:])
    # The share of false discoveries is one of the whole table, so a few borderline runs may go either way: one in twenty at most.
    assert differ <= 15 and sum(alone[i] != halves[i] for i in alone) <= 15


def test_a_single_key_in_a_table_of_one_row(spark):
    rng = random.Random(9)
    assert sum(bool(found_in(spark, [row])[row[0]]) for row in keys(rng, 5)) >= 3


def test_step_up_against_sorted_p_values():
    rng = random.Random(10)
    for _ in range(50):
        null = {c: rng.randrange(0, 30) for c in rng.sample(range(secrets.BINS), 40)}
        seen = {c: rng.randrange(1, 4) for c in rng.sample(range(secrets.BINS), 30)}
        p = {b: (1 + sum(n for c, n in null.items() if c >= b)) / (1 + sum(null.values())) for b in seen}
        ranked = sorted(b for b, n in seen.items() for _ in range(n))[::-1]
        # Ties of one bin share its lowest rank; bin 0 fits nothing.
        good = [b for b in set(ranked) if b and p[b] <= 0.2 * sum(x >= b for x in ranked) / len(ranked)]
        got = secrets.discoveries(seen, null, 0.2).get(0)
        kept = sorted(b for b in seen if got is not None and b >= got)
        assert kept == sorted(b for b in seen if good and b >= min(good))


def test_the_three_tests_tell_random_from_regular():
    rng = random.Random(11)
    letters = secrets.ALPHABETS["mixed"]
    fits = [secrets.randomness("".join(rng.choices(letters, k=48))) for _ in range(400)]
    assert abs(np.mean(fits) - 0.5) < 0.12
    regular = ["abcdefgh12345678" * 3, "a1" * 24, "abc123" * 8, "1234567890abcdefghij" * 2]
    assert all(secrets.randomness(x) < 0.01 for x in regular)


def test_a_rare_term_of_a_small_language_is_learned(spark):
    rng = random.Random(12)
    common_words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(9000):
        words = rng.choices(common_words, k=25)
        toxic = i % 3 == 0
        if toxic:
            # One toxic row in 300 insults in another language only.
            words[rng.randrange(25)] = "грязныйтип" if i % 900 == 0 else "zerbolid"
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(toxic)))
    # More of the rare ones, so that some are held out: still 0.3 % of the toxic rows of the sample.
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    extra = [(20_000 + i, " ".join([*rng.choices(common_words, k=24), "грязныйтип"]), "ru", "s", 1) for i in range(12)]
    more = marks.union(spark.createDataFrame([(r[0], 1) for r in extra], "doc_id long, toxic int"))
    whole = docs.union(spark.createDataFrame(extra, SCHEMA))
    model = toxicity.fit(whole, more)
    probe = spark.createDataFrame([(1, " ".join([*common_words[:24], "грязныйтип"]), "ru", "s", 1), (2, " ".join(common_words[:25]), "en", "s", 1)], SCHEMA)
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(probe, model).collect()}
    assert got == {1: 1, 2: 0}


def test_pairs_of_characters_of_unspaced_scripts():
    raw = np.frombuffer("漢字仮名 ab漢".encode() + "字".encode(), dtype=np.uint8)
    offsets = np.array([0, len(raw) - 3, len(raw)])
    found = [rows.tolist() for kind, rows, _ in toxicity.features(raw, offsets) if kind == toxicity.CHARACTERS]
    assert found == [[0, 0, 0]]


def odd_columns(spark):
    rows = [(1, "one two three four five six", "en", "a", 1), (1, "one two three four five six seven", "en", None, 2), (2, "one two three four five six", None, "b", 3), (None, None, None, None, None), (3, "", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"a.b": F.lit("z"), "ti`ck": F.lit(1), "kinds": F.create_map(F.lit("k"), F.col("source")), "__row": F.lit("x"), "score": F.lit(2)})


STAGES = {
    "toxic": lambda df: toxicity.drop_toxic(df, toxicity._default()),
    "near": neardup.drop_near_duplicates,
    "secrets": secrets.redact_secrets,
    "mix": mixing.take_mix,
}


@pytest.mark.parametrize("name", STAGES)
def test_row_stages_take_odd_columns_and_empty_tables(spark, name):
    docs = odd_columns(spark)
    for df in (docs, docs.limit(0)):
        out = STAGES[name](df)
        assert out.columns == docs.columns
        rows = out.collect()
        assert len(rows) <= 2 * df.count()
    if name == "near":
        assert sorted(r["doc_id"] or 0 for r in STAGES[name](docs).collect()) == [0, 1, 3]


def test_packing_takes_odd_columns(spark):
    assert packing.pack_documents(odd_columns(spark), vocabulary()).count() > 0


def test_vectors_are_not_dealt_by_their_length_alone(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(100)], "vec_id long, embedding array<double>")
    plan = topk.top_inner_products(df, df.where("vec_id % 50 = 0"))._jdf.queryExecution().toString()
    assert not re.search(r"hashpartitioning\(dim#\d+, \d+", plan) and "SinglePartition" not in plan


def test_packing_ranges_follow_the_bytes(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat(concat('word', id % 7, ' '), 50) AS text")
    assert packing.range_count(docs) == 1
    assert packing.range_count(docs.where("doc_id < 0")) == 1
    monkeypatch.setattr(packing, "RANGE_BYTES", 9_000)
    assert packing.range_count(docs) == 10
    pieces = packing.pack_documents(docs, vocabulary())
    ends = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"), F.count_distinct("start").alias("starts"), F.count("*").alias("pieces"))
    assert ends.where("n = doc_tokens AND starts = pieces").count() == 300
    monkeypatch.setattr(packing, "MAX_RANGES", 4)
    assert packing.range_count(docs) == 4


def test_words_against_are_weighed_and_do_not_decide(spark):
    rows = [(i, f"mail a{i}@b.example, card 4111 1111 1111 1111 and +1 (555) 010-00{i % 10}{i // 10}, on page 1{i:02d}-22{i:02d}0 or item 2{i:02d} 5{i:02d} 0{i:02d}") for i in range(60)]
    rows += [(100, "call no +49 (30) 5555-3296 4111111111111111 now"), (101, "see isbn 978-316-1484, year 123-456-7890"), (102, "call +999 (30) 555-32 now")]
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[100] == [("number", 8, 26), ("number", 27, 43)]
    assert spans[101] == []
    assert all([k for k, *_ in spans[i]] == ["email", "card", "phone"] for i in range(60))


def test_calling_codes_have_national_lengths(spark):
    rows = [(1, "phone", "+15550100022"), (2, "phone", "+1555010002"), (3, "phone", "+493055553296"), (4, "phone", "+35315550100"), (5, "phone", "+21055501000")]
    spans = spark.createDataFrame([(i, i, k, 0, len(s), s, "", "") for i, k, s in rows], "row long, doc_id long, kind string, start int, end int, span string, before string, after string")
    votes = {r.doc_id: r.v_gazetteer for r in pii.judged(spans).collect()}
    assert votes == {1: 1, 2: -1, 3: 1, 4: 1, 5: 1}
    assert all(re.search(f"^(?:{zone})$", code) for code, (zone, *_) in zip(("1", "49", "353"), pii.CALLING, strict=True))


def test_packing_works_out_places_once_and_ranges_are_even(spark, monkeypatch):
    """Range limits come from sampled documents, weighed by bytes; ranges are dealt by number and not sampled again."""
    rows = [(i, f"w{i % 97} v{i} " * (400 if i % 50 == 0 else 8)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(packing, "RANGE_BYTES", 40_000)
    packed = packing.pack_documents(docs, vocabulary())
    assert "rangepartitioning" not in packed._jdf.queryExecution().executedPlan().toString()
    tied = docs.withColumn("tie", F.xxhash64("doc_id", "text"))
    limits = packing.range_limits(tied)
    assert len(limits) + 1 >= packing.range_count(docs) - 1
    dealt = tied.mapInArrow(packing._keyed(limits), "range int, key long, doc_id long, text string, tie long")
    sizes = [r.b for r in dealt.groupBy("range").agg(F.sum(F.octet_length("text")).alias("b")).collect()]
    assert len(sizes) == len(limits) + 1 and max(sizes) < 2.5 * 40_000
    got = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert len(got) == 2000 and all(r.n == r.t for r in got)


def _chain(spark, n):
    """Labels of n ids and links of each id to the next, dealt over many partitions."""
    labels = spark.range(n).selectExpr("id AS cid", "id AS comp").repartition(64, "cid").localCheckpoint()
    links = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b").where("a % 500 <> 499").repartition(64, "a").localCheckpoint()
    return labels, links


def test_links_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TASK_IDS", 300)
    labels, links = _chain(spark, 2000)
    links = links.union(links.selectExpr("b AS a", "a AS b").where("a % 3 = 0"))
    assert {r.cid: r.comp for r in neardup.contracted(labels, links).collect()} == {i: i - i % 500 for i in range(2000)}


def test_few_links_take_few_jobs_and_tasks(spark):
    """Every job is plans, events and threads of the driver, and every task an event."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    labels, links = _chain(spark, 2000)
    empty = neardup.checkpointed(links.where("a < 0"))
    tracker, counts = spark.sparkContext.statusTracker(), {}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for group, given in (("chains", links), ("none", empty)):
            spark.sparkContext.setJobGroup(group, group)
            found = neardup.contracted(labels, given)
            jobs = tracker.getJobIdsForGroup(group)
            stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
            counts[group] = len(jobs), sum(x.numTasks for x in map(tracker.getStageInfo, stages) if x and x.numCompletedTasks)
            want = {i: i - i % 500 if group == "chains" else i for i in range(2000)}
            assert {r.cid: r.comp for r in found.collect()} == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # (69, 3545) and (6, 194) before links were thinned within tasks.
    assert counts["chains"][0] <= 35 and counts["chains"][1] <= 1500 and counts["none"][0] <= 2, counts


def test_stars_connect_what_the_edges_connect():
    rng = np.random.default_rng(3)
    for n, m in ((1, 0), (5, 3), (300, 200), (300, 900), (5000, 4000)):
        u, v = rng.integers(0, n, m) * 7, rng.integers(0, n, m) * 7
        parent = {i: i for i in [*u.tolist(), *v.tolist()]}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for x, y in zip(u.tolist(), v.tolist(), strict=True):
            x, y = sorted((root(x), root(y)))
            parent[y] = x
        low, other = neardup._stars(u.astype(np.int64), v.astype(np.int64))
        assert dict(zip(other.tolist(), low.tolist(), strict=True)) == {i: root(i) for i in parent if root(i) != i}
