"""Spend source files: arrays cut at record borders, against json.loads; memory of a large file."""

import json
import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from slotflow.sources import readers
from conftest import ROOT


def write(folder, texts):
    os.makedirs(folder, exist_ok=True)
    for i, text in enumerate(texts):
        with open(f"{folder}/spend_data_2024-01-{i + 1:02d}.json", "w") as f:
            f.write(text)


def read(spark, folder):
    out = {}
    rows = readers.read_spend_files(spark, folder)
    for r in rows.select("source_file", "body", "error", F.to_json("fields").alias("fields")).collect():
        out.setdefault(int(r["source_file"][-7:-5]) - 1, []).append((r["error"], r["body"], json.loads(r["fields"]) if r["fields"] else None))
    return out


def expected(text):
    """What json.loads makes of a file: None if it is no array, else (objects, other elements)."""
    try:
        data = json.loads(text)
    except ValueError:
        return None
    return ([x for x in data if isinstance(x, dict)], [x for x in data if not isinstance(x, dict)]) if isinstance(data, list) else None


BRACES = '{"a": "}{\\"}", "b": {"c": [{"d": "]"}, {}], "e": "\\\\"}}'
TEXTS = [
    "[]", " [ ] \n", "", "   ", "[", "]", "{}", '{"a": 1}', "7", '"x"', "[1, 2, 3]", "[1, [2, {}], {}]", '[{"a": 1}]', '[{"a": 1},]', '[,{"a": 1}]',
    '[{"a": 1} {"b": 2}]', f"[{BRACES}]", f"[{BRACES},{BRACES} ,\n{BRACES}\n]", '[{"a": 1}', '[{"a": 1}]]', '[{"a": 1}][{"b": 2}]', "[1][2]",
    '[{"a": "unclosed}]', '[{"a" 1}]', '[{"a": "\\u007d"}, null, true, "s}", -1.5e3]', '[[{"a": 1}, {"b": [{}]}], {"c": 2}]', '[{"a": 1}] x', '[{"é": "日本 🙂 }"}]', "[{broken",
]


def test_files_against_json_loads(spark, tmp_dir):
    write(tmp_dir, TEXTS)
    got = read(spark, tmp_dir)
    for i, text in enumerate(TEXTS):
        rows, want = got.get(i, []), expected(text)
        if want is None:
            assert rows and all(e == "not a JSON array" for e, _, _ in rows), text
            assert sorted("".join(b for _, b, _ in rows)) == sorted(text)  # its whole text is kept, in parts
        else:
            objects = [f for e, _, f in rows if e is None]
            others = [json.loads(b) if not b.startswith("s") else b for e, b, _ in rows if e == "not a JSON object"]
            key = lambda x: json.dumps(x, sort_keys=True)
            assert sorted(map(key, objects)) == sorted(map(key, want[0])), text
            assert len(others) == len(want[1]), text


def test_random_arrays_and_cuts(spark, tmp_dir):
    """Arrays of random nested values, whole and damaged by one lost character."""
    rng = random.Random(8)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return rng.choice(["}", '"', "\\", "a,]", "[{", 3, None, True, "é}"])
        return [value(depth - 1) for _ in range(rng.randrange(3))] if kind == 3 else {rng.choice("ab}[\""): value(depth - 1) for _ in range(rng.randrange(3))}

    texts = [json.dumps([{"k": value(3), "n": j} for j in range(rng.randrange(5))], indent=rng.choice([None, 2])) for _ in range(14)]
    for t in texts[:14]:
        at = rng.randrange(len(t))
        texts.append(t[:at] + t[at + 1 :])
    write(tmp_dir, texts)
    got = read(spark, tmp_dir)
    for i, text in enumerate(texts):
        want, rows = expected(text), got.get(i, [])
        if want is None:
            assert rows and all(e == "not a JSON array" for e, _, _ in rows), text
        else:
            key = lambda x: json.dumps(x, sort_keys=True)
            assert sorted(key(f) for e, _, f in rows if e is None) == sorted(map(key, want[0])), text


def test_splits_of_one_file(spark, tmp_dir):
    """A file read in many splits gives the same records."""
    write(tmp_dir, [json.dumps([{"i": i, "t": "}{\"" * (i % 7), "n": {"x": [i]}} for i in range(3000)])])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "9000")
        rows = readers.read_spend_files(spark, tmp_dir)
        assert sorted(r[0] for r in rows.where("error IS NULL").select(F.element_at("fields", "i").cast("int")).collect()) == list(range(3000))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


CHILD = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.driver.memory", "480m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate())
from slotflow.sources import readers
rows = readers.read_spend_files(spark, sys.argv[2])
out = rows.agg(F.count_if(F.col("error").isNull()), F.count("error"), F.sum(F.length(F.element_at("fields", "text").cast("string")))).first()
print("RESULT", *out)
"""


def test_memory_is_a_records_not_a_files(tmp_dir):
    """One file of 10^5 records, 100 MB, on one line, in a heap of 480 MB with two tasks."""
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/spend_data_2024-01-01.json", "w") as f:
        f.write("[")
        for i in range(100_000):
            f.write(("," if i else "") + json.dumps({"date": "2024-01-01", "channel": "c", "spend": i, "text": "x" * 950}))
        f.write("]")
    done = subprocess.run([sys.executable, "-c", CHILD, ROOT, f"{tmp_dir}/src"], capture_output=True, text=True, timeout=600)
    assert "RESULT 100000 0 95000000" in done.stdout, done.stderr[-3000:]


def test_parts_follow_the_input_and_documents_the_parts(spark, tmp_dir, monkeypatch):
    """Source files of the fixture are parts of PART_RECORDS elements in order; a document holds the
    records of one part; the tasks that cut files become more with their bytes."""
    from slotflow.config import PipelineConfig
    from slotflow.plans.batch_jobs import ingest_spend
    from slotflow.sources import adapters as AD

    monkeypatch.setattr(AD, "PART_RECORDS", 7)
    AD.spend_source_files(spark, "/root/testdata/sf0.001").drop("part").write.option("maxRecordsPerFile", 7).partitionBy("file").text(f"{tmp_dir}/src")
    sizes, ids = {}, {}
    for folder in sorted(os.listdir(f"{tmp_dir}/src")):
        for name in os.listdir(f"{tmp_dir}/src/{folder}") if folder.startswith("file=") else ():
            if name.startswith("part-"):
                with open(f"{tmp_dir}/src/{folder}/{name}") as f:
                    lines = f.read().splitlines()
                assert lines[0].startswith("[") and all(x.startswith(",") for x in lines[1:])
                assert lines[-1].endswith("]") != folder.endswith("-13.json")
                sizes.setdefault(folder, []).append(len(lines))
    assert all(max(v) <= 7 and sum(n < 7 for n in v) <= 1 for v in sizes.values()) and max(map(len, sizes.values())) > 1
    assert sum(map(sum, sizes.values())) == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    monkeypatch.setattr(readers, "BYTES_A_SPLIT", 2000)
    plan = readers.read_spend_files(spark, f"{tmp_dir}/src")._jdf.queryExecution().optimizedPlan().toString()
    assert int(plan.split("RepartitionByExpression [path")[1].split("], ")[1].split("\n")[0].split(",")[0]) > 8
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_parts")
    ingest_spend(spark, f"{tmp_dir}/src", cfg, lookback_days=1000, execution_date="2024-02-01")
    docs = spark.read.option("recursiveFileLookup", "true").schema("records array<map<string,variant>>, metadata struct<record_count:long>").json(cfg.bronze_spend)
    counts = docs.select(F.size("records").alias("n"), "metadata.record_count").collect()
    assert counts and all(n == m and n <= 7 for n, m in counts)
