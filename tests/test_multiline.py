"""Files with quoted line breaks, read in byte ranges: same rows as Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from lakelayer.contracts import Contract, Field
from lakelayer.sources import multiline
from lakelayer.sources.csv import read_csv_contract, read_csv_raw

CONTRACT = Contract("reviews", 1, (Field("id", "string", nullable=False), Field("score", "integer"), Field("text", "string")), multi_line=True)


def write(path, rows, seed, newline="\n", header="id,score,text"):
    rng = random.Random(seed)
    pieces = ["plain", 'say ""hi""', "a, comma", "line\nbreak", "\n\n", "", "é", '""', "tail\n", "\nhead"]
    out = [header]
    for i in range(rows):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
        out.append(f'r{i},{rng.choice(["1", "5", "x", ""])},"{text}"' if rng.random() < 0.7 else f"r{i},{i},no quotes")
        if rng.random() < 0.05:
            out.append(rng.choice(["", "short,1", f'q{i},2,"a\nb",too many']))
    path.write_bytes((newline.join(out) + newline).encode())


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,newline", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_ranges_give_the_rows_of_the_file_reader(spark, tmp_path, small_ranges, seed, newline):
    for name, n in (("a.csv", 300), ("b.csv", 1), ("c.csv", 40)):
        write(tmp_path / name, n, seed * 10 + n, newline)
    (tmp_path / "empty.csv").write_text("id,score,text\n")
    raw = read_csv_raw(spark, str(tmp_path), CONTRACT)
    assert multiline.records(spark, [str(tmp_path)]).select("_file").distinct().count() == 4
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    whole = read_csv_raw(spark, str(tmp_path), CONTRACT, split=False)
    assert rows(raw.drop("_source_file")) == rows(whole)
    typed = read_csv_contract(spark, str(tmp_path), CONTRACT, source_file=True)
    assert rows(typed) == rows(read_csv_contract(spark, str(tmp_path), CONTRACT, source_file=True, split=False).select(*typed.columns))
    assert typed.filter("_corrupt_record IS NOT NULL").count() > 0


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i} with ""doubled"" quotes" for i in range(500))
    (tmp_path / "a.csv").write_text(f'id,score,text\nr1,1,"{long}"\nr2,2,short\nr3,3,"{long}"')
    got = {r.id: r.text for r in read_csv_contract(spark, str(tmp_path / "a.csv"), CONTRACT).collect()}
    assert got == {"r1": long, "r2": "short", "r3": long}


def test_headers_are_checked_and_matched_by_name(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", 60, 5)
    assert rows(read_csv_contract(spark, str(tmp_path / "a.csv"), CONTRACT, match_by_name=True)) == rows(read_csv_contract(spark, str(tmp_path / "a.csv"), CONTRACT))
    (tmp_path / "b.csv").write_text('text,score,id\n"x\ny",1,r1\n')
    got = read_csv_contract(spark, str(tmp_path / "b.csv"), CONTRACT, match_by_name=True).first()
    assert (got.id, got.text) == ("r1", "x\ny")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_contract(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], CONTRACT, match_by_name=True).collect()


def test_other_quoting_is_left_to_the_file_reader(spark, tmp_path):
    c = Contract("reviews", 1, CONTRACT.fields, multi_line=True, options={"escape": "\\"})
    (tmp_path / "a.csv").write_text('id,score,text\nr1,1,"a \\" b\nc"\n')
    assert read_csv_contract(spark, str(tmp_path / "a.csv"), c).select(F.col("text")).first()[0] == 'a " b\nc'
