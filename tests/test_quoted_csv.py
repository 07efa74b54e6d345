"""CSV records with quoted line breaks, cut rightly in any number of splits."""

import csv
import random

import pytest

from strata.sources import readers as rd
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])
BITS = ["x", '"', ",", "\n", "\r\n", "yy", " ", '""', "é"]


def write(path, n, seed):
    rnd = random.Random(seed)
    rows = [[str(i), "".join(rnd.choice(BITS) for _ in range(rnd.randint(1, 9))) + "z", rnd.choice(["", "p", "line\nbreak"])]
            for i in range(n)]
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL)
        w.writerows([["a", "b", "c"], *rows])
    return {int(a): (b, c or None) for a, b, c in rows}


@pytest.mark.parametrize("split", ["40", "300", "128m"])
def test_records_survive_any_split(spark, tmp, split):
    want = write(f"{tmp}/one.csv", 200, 1) | {k + 1000: v for k, v in {}.items()}
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = rd.read_csv_rescued(spark, f"{tmp}/one.csv", SCHEMA, multi_line=True).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    got = {r.a: (r.b, r.c or None) for r in rows}
    assert len(rows) == len(want)
    assert {k: (b.strip(), c) for k, (b, c) in got.items()} == {k: (b.strip(), c) for k, (b, c) in want.items()}
    assert all(r._rescued_data is None for r in rows)


def test_two_files_of_other_layouts_and_failed_casts(spark, tmp):
    for name, text in (("x", 'a,b,c\n1,"one\ntwo",p\n"n\n1",q,r\n'), ("y", 'c,a,extra\n"u\nv",7,"e\n"\n\n')):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(text)
    rows = sorted(rd.read_csv_rescued(spark, f"{tmp}/*.csv", SCHEMA, multi_line=True).collect(), key=str)
    got = {(r.a, r.b, r.c, None if r._rescued_data is None else tuple(sorted(r._rescued_data.items()))) for r in rows}
    assert got == {(1, "one\ntwo", "p", None), (None, "q", "r", (("a", "n\n1"),)), (7, None, "u\nv", (("extra", "e\n"),))}


def test_a_quote_that_is_never_closed_names_the_file(spark, tmp):
    with open(f"{tmp}/bad.csv", "w") as f:
        f.write('a,b,c\n1,"open,x\n' + "2,y,z\n" * 50)
    raw = spark.read.text(f"{tmp}/bad.csv").selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS start")
    with pytest.raises(ValueError, match="bad.csv"):
        rd.quoted_records(raw, max_lines=20)
