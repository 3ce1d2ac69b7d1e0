"""Operators that SQL does not express, against plain Python; edges of the others."""

import os
import random
import re

import duckdb
from pyspark.sql import functions as F

from siftwell.functions import text as T
from siftwell.operators import audit, clusters, code, curation, distill, sampling
from siftwell.plans import audit_queries, curation_queries, more_queries  # noqa: F401
from siftwell.plans.registry import ORACLES, QUERIES
from siftwell.sources import io, scratch
from siftwell.streaming import incremental


def leaders(texts, threshold, k=5):
    def shingles(t):
        t = "_".join(t.strip().lower().split())
        return {t[i : i + k] for i in range(len(t) - k + 1)} if len(t) >= k else {t} if t else set()

    sets, out = {i: shingles(t) for i, t in texts}, {}
    for i, _ in sorted(texts):
        if i in out:
            continue
        out[i] = i
        for j, _ in sorted(texts):
            if j > i and j not in out and len(sets[i] & sets[j]) / (len(sets[i] | sets[j]) or 1) >= threshold:
                out[j] = i
    return out


def test_leader_clusters(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(6)]
    texts = []
    for i in range(60):
        w = base[i % 6].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append((i, " ".join(w)))
    texts += [(60, ""), (61, ""), (62, "abc"), (63, "abc")]
    got = {r["id"]: r["leader"] for r in clusters.leader_clusters(spark.createDataFrame(texts, "id long, text string"), "id", "text", 0.85).collect()}
    assert got == leaders(texts, 0.85)


def test_greedy_budget_passes_over_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, 6), (2, 5), (3, 4)], "i long, t long")
    assert [r["i"] for r in sampling.greedy_budget(df, "i", "t", 10).orderBy("i").collect()] == [1, 3]


def test_greedy_budget_in_blocks(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 100)) for i in range(500)]
    left, want = 9000, []
    for i, t in rows:
        if t <= left:
            want.append(i)
            left -= t
    got = sampling.greedy_budget(spark.createDataFrame(rows, "i long, t long"), "i", "t", 9000)
    assert [r["i"] for r in got.orderBy("i").collect()] == want


def test_exact_dedup_of_records_without_conversation(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, [("user", "a")]), (4, [("user", "a")])], "conv_id long, conversation array<struct<role:string,content:string>>")
    assert [r[0] for r in curation.exact_dedup_records(df).select("conv_id").orderBy("conv_id").collect()] == [1, 3]


def test_quality_score_edges(spark):
    df = spark.createDataFrame([("",), ("123 456",), ("alpha beta",), (None,)], "t string")
    assert [round(r[0], 3) for r in df.select(T.quality_score(F.col("t"))).collect()] == [0.0, 0.0, 0.8, 0.0]


def test_imports_fall_back_to_patterns():
    assert code.imports_of("import os\nfrom .a import b\nx = (") == [{"name": "os", "module_type": "stdlib"}, {"name": ".a", "module_type": "relative"}]


def test_distillation_leaves_the_tail_alone():
    para = "one two three four five six seven " * 30
    text = f"{para}\n\n{para}\n\nother words entirely that stay here for good</think><tool_call>x</tool_call>"
    short = distill.distill_text(text, 100)
    assert short.endswith("</think><tool_call>x</tool_call>") and short.count(para.strip()) == 1 and "stay here" in short
    assert distill.distill_text("no tags", 1) == "no tags"


def test_last_bullets_and_lines():
    assert distill.without_repeated_items("- a b\n- a b\ntext") == "- a b\ntext"
    line = "this line is long enough"
    assert distill.without_line_runs("\n".join([line] * 5)) == "\n".join([line] * 2)


def test_jsonl_round_trip(spark, tmp_path):
    p = str(tmp_path / "a")
    io.write_jsonl(spark.createDataFrame([(1, "é"), (2, None)], "id long, t string"), p)
    assert sorted(map(tuple, io.read_jsonl(spark, p, "id long, t string").collect())) == [(1, "é"), (2, None)]
    (tmp_path / "b.jsonl").write_text('{"id": 1}\n\n{"id": \n{"id": 3}\n')
    b = str(tmp_path / "b.jsonl")
    assert [r["id"] for r in io.read_jsonl(spark, b, "id long").orderBy("id").collect()] == [1, 3]
    assert io.read_jsonl(spark, b, "id long", mode="mark").filter("_corrupt is not null").count() == 1


def test_registry_and_split(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "variant string, timestamp string")
    io.write_registry(df, str(tmp_path / "r"))
    assert [r["timestamp"] for r in io.read_registry(spark, str(tmp_path / "r"), last=1).collect()] == ["2"]
    io.write_split(df, F.col("variant") == "a", str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).filter("status = 'accepted'").count() == 1


def test_tree(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / ".git").mkdir()
    (tmp_path / "x" / "a.php").write_bytes("é".encode("latin-1"))
    (tmp_path / "x" / "b.php").write_bytes(bytes(range(1, 9)) * 4)
    (tmp_path / ".git" / "c.php").write_text("no")
    got = {r["path"].rpartition("/")[2]: r["text"] for r in io.read_tree(spark, str(tmp_path), "*.php").collect()}
    assert got == {"a.php": "é", "b.php": None}


def test_stream_dedup(spark, tmp_path):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "t string, s long").selectExpr("t", "timestamp_seconds(s) ts")
    src.write.parquet(str(tmp_path / "in"))
    stream = incremental.dedup_stream(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")), "t", "ts")
    q = stream.writeStream.format("memory").queryName("dedup_out").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["t"] for r in spark.sql("select t from dedup_out").collect()) == ["a", "b"]


def test_first_of_tied_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "b"), (3, None), (4, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in curation.exact_dedup_texts(df).collect())
    assert got == [(-1, "b"), (1, "a"), (3, "")]


def test_greedy_budget_of_tied_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (3, None)], "i long, t long")
    got = sampling.greedy_budget(df, "i", "t", 5).collect()
    assert sorted((r["i"], r["t"] or 0) for r in got) == [(1, 5), (3, 0)]
    assert sampling.greedy_budget(df, "i", "t", 10).count() == 3 and sampling.greedy_budget(df.limit(0), "i", "t", 10).count() == 0


def test_distillation_steps():
    block = "```python\nprint(total_of_all_rows, 1)\nreturn result\n```"
    assert distill.without_earlier_code(f"one\n{block}\ntwo\n{block}\nend") == f"one\n\ntwo\n{block}\nend"
    assert distill.without_earlier_code(f"one\n```\nx\n```\n```\nx\n```") == "one\n```\nx\n```\n```\nx\n```"
    assert distill.without_repeated_items("- Same, thing\nplain\n- same thing\n2) other\nplain") == "- Same, thing\nplain\n2) other\nplain"
    cycle = ["1. look at the input and the output", "2. then write the code"]
    assert distill.without_earlier_cycles(["start", *cycle, *cycle, "1. something quite different, unlike all", "x"]) == ["start", *cycle, *cycle, "1. something quite different, unlike all", "x"]
    assert distill.without_earlier_cycles(["start", *cycle, *cycle]) == ["start", *cycle]
    a, b = "The coordinator polls the device every thirty seconds.", "The coordinator polls the device every sixty seconds."
    assert distill.without_earlier_paragraphs([a, "short", "other words stand here, nothing alike at all", b, "short"]) == ["short", "other words stand here, nothing alike at all", b, "short"]
    thought = "\n\n".join([a] * 200)
    assert distill.distill_text(f"{thought}</think>{thought}") == f"{a}</think>{thought}"
    assert distill.distill_text(f"{a}</think>x") == f"{a}</think>x"


def test_leader_clusters_in_rounds_and_at_once(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(80)]
    base, texts = [rng.choice(words) for _ in range(60)], []
    for i in range(24):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append((i, " ".join(w)))
    want, df = leaders(texts, 0.85), spark.createDataFrame([*texts, (24, None)], "id long, text string")
    assert 3 < len(set(want.values())) < 15
    for most in (6, 32):
        got = {r["id"]: r["leader"] for r in clusters.leader_clusters(df, "id", "text", 0.85, most=most).collect()}
        assert got == want | {24: 24}


def test_leader_clusters_write_less_than_the_texts(spark, monkeypatch):
    """sets of shingles on disk were eight bytes a character, and were exchanged in every round."""
    rng, written = random.Random(2), []

    def count(df, name):
        out = scratch.materialize(df, name)
        path = out._scratch.removeprefix("file://")
        written.extend(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
        return out

    monkeypatch.setattr(clusters, "materialize", count)
    texts = [(i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(8000))) for i in range(100)]
    texts += [(100 + i, t + " tail") for i, t in texts[:20]]
    got = {r["id"]: r["leader"] for r in clusters.leader_clusters(spark.createDataFrame(texts, "id long, text string"), "id", "text").collect()}
    assert got == {i: i % 100 if i >= 100 else i for i, _ in texts} and sum(written) < sum(len(t) for _, t in texts)


def test_pattern_penalty_without_text(spark, tmp_path):
    """the SQL counts every pattern as missing in an empty or null text."""
    p = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "THE undone zzz"), (2, ""), (3, None), (4, "the"), (5, " ")], "doc_id long, text string").coalesce(1).write.parquet(p)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{p}/*.parquet'")
    want = c.execute(ORACLES["a8_pattern_penalty"]).fetchall()
    assert sorted(map(tuple, QUERIES["a8_pattern_penalty"](spark, str(tmp_path)).collect())) == sorted(want)
    bare = spark.createDataFrame([("",), (None,)], "t string")
    assert [r[0] for r in bare.select(audit.pattern_penalty(F.col("t"), F.array(F.lit("x")))).collect()] == [0.0, 0.0]


def test_weighted_best_ranks_in_ranges(spark):
    """all rows went to one task, to be ranked in one window."""
    rng = random.Random(4)
    rows = [(float(rng.randint(1, 9)), rng.choice([None, *map(float, range(1, 40))])) for _ in range(900)]
    df = spark.createDataFrame(rows, "p double, score double").repartition(5)
    for share in (0.0, 0.25, 0.6):
        best = [(p, s) for p, s in rows if s is not None and sum(t is not None and t > s for _, t in rows) / (len(rows) - 1) <= share]
        got = audit.weighted_best(df, "p", "score", share)
        assert abs(got.first()[0] - sum(p * s for p, s in best) / sum(s for _, s in best)) < 1e-9
        assert not re.search(r"windowspecdefinition\(score", got._jdf.queryExecution().optimizedPlan().toString())
    assert audit.weighted_best(df.limit(1).withColumn("score", F.lit(2.0)), "p", "score").first()[0] is not None
    assert audit.weighted_best(df.limit(0), "p", "score").first()[0] is None


def test_code_words_branch_by_letter():
    """every place of a text was tried against every code word, and the text cleaned again for each of its counts."""
    rng, plain, tree = random.Random(6), re.compile(rf"\b(?:{'|'.join(T.CODE_WORDS)})\b"), re.compile(rf"\b{T._any_of(T.CODE_WORDS)}\b")
    parts = [*T.CODE_WORDS, "_", " ", "x", ".", "asyn", "entry_i", "é", "\n"]
    for _ in range(300):
        t = "".join(rng.choice(parts) + rng.choice(["", " ", "("]) for _ in range(40))
        assert plain.findall(t) == tree.findall(t)


def test_density_cleans_a_text_once(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = df.select(T.logic_density(F.regexp_replace("t", "[^ -~]", ""))).select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(t#") == 1


def test_shingle_jaccard_against_its_sql(spark, tmp_path):
    """shingles were strings in interpreted lambdas, and a null text had one."""
    rng = random.Random(8)
    wide = "".join(chr(0x4E00 + i) for i in range(6000))
    texts = ["", None, "abc", "ABC ", "abcde", " abcde\n", "abcdef", None, None, "", "", "\t ", "aaaaaaaaa", "aaaaaa", wide, wide[100:] + "x", "\U0001F600" * 9, "\U0001F600" * 6 + "ab", "a\u0301e b  c", "ab"]
    texts += ["".join(rng.choice("ab é") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    p = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(p)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{p}/*.parquet'")
    want = c.execute(ORACLES["t1_t3_shingle_jaccard"]).fetchall()
    assert sorted(map(tuple, QUERIES["t1_t3_shingle_jaccard"](spark, str(tmp_path)).collect())) == sorted(want)


def test_shingle_jaccard_compares_texts_not_arrays(spark):
    plan = QUERIES["t1_t3_shingle_jaccard"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
