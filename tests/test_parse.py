import random

import pytest
from pyspark.sql import functions as F

from regloom.functions.hashing import row_hash, tuple_text
from regloom.functions.text import split_lines, strip
from regloom.jurisdictions import layout_for
from regloom.operators.parse import explode_lines, parse_fixed_width, render_fixed_width
from regloom.operators.rows import with_chunk_index
from regloom.plans.layout import Layout
from regloom.sources.readers import read_lines, write_numbered_lines

THREE = Layout.from_dict(
    {
        "meta_data": {"length": 22},
        "fields": [
            {"name": "COR_NUMBER", "start": 1, "end": 12},
            {"name": "COR_NAME", "start": 13, "end": 20},
            {"name": "COR_STATUS", "start": 21, "end": 22},
        ],
    }
)
SHIFTED = Layout.from_dict(
    {
        "fields": [
            {"name": "COR_NUMBER", "start": 2, "end": 13},
            {"name": "COR_NAME", "start": 14, "end": 21},
            {"name": "COR_STATUS", "start": 22, "end": 23},
        ]
    }
)
TWO = Layout.from_dict({"fields": [{"name": "a", "start": 1, "end": 5}, {"name": "b", "start": 6, "end": 10}]})

# Lines, their cells and their hashes, as the hash must come out; THREE and SHIFTED are their layouts.
GOLDEN = [
    (THREE, "L24000407310ABCD LLCXY", ("L24000407310", "ABCD LLC", "XY", "SPTscM6htn9_ScYpM6BpjU")),
    (THREE, "L24000407320APPLE INYX", ("L24000407320", "APPLE IN", "YX", "VLiUOCZssSq2-br5HPpPr0")),
    (THREE, "L24000407320APPLE IN", ("L24000407320", "APPLE IN", "", "IW6727l9KTns4XAeZVGyJI")),
    (SHIFTED, " L24000407310ABCD LLCX", ("L24000407310", "ABCD LLC", "X", "e28B40-FROgKO8SdZVc3Es")),
    (SHIFTED, " L24000407320APPLE INY", ("L24000407320", "APPLE IN", "Y", "g9jTEXNqRj5-brHKmuHSm0")),
    (TWO, "1234567890", ("12345", "67890", "lCNYoUWhll5-5Z2nbxhF-M")),
    (TWO, "0987654321", ("09876", "54321", "nCamtIqAJIg6MA3ZpRoKfc")),
    (TWO, "1122334455", ("11223", "34455", "5iElFTiurdL1CAh1dfKBjw")),
    (TWO, "5566778899", ("55667", "78899", "ysUUUjilK9xqtvWET-2JVA")),
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("layout", [THREE, SHIFTED, TWO])
def test_golden_rows(spark, layout):
    cases = [(text, row) for where, text, row in GOLDEN if where is layout]
    got = parse_fixed_width(lines(spark, [c[0] for c in cases]), layout).collect()
    assert sorted(tuple(r) for r in got) == sorted(c[1] for c in cases)


def test_without_hash(spark):
    got = parse_fixed_width(lines(spark, ["1234567890"]), TWO, add_hash=False)
    assert got.columns == ["a", "b"]


def python_parse(line, layout):
    line = line.replace('"', "").replace("\r\n", "\n").replace("\x00", "")
    return [line[f.start - 1 : f.end].strip() for f in layout.fields]


def python_hash(values):
    import base64
    import hashlib

    digest = hashlib.sha256(str(tuple(values)).encode()).digest()
    return base64.urlsafe_b64encode(digest).decode()[::2]


ALPHABET = list("ABC xyz09'\\\"\t\x00\x01\x1f\x7f\x85") + [chr(c) for c in (0xA0, 0xAD, 0xE9, 0x3B1, 0x200B, 0x2003, 0x3000, 0xFFFD, 0x1F600, 0xE000)]


def test_random_lines_equal_python(spark):
    rng = random.Random(7)
    values = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(400)] + ["", "   "]
    got = parse_fixed_width(
        spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string"), THREE, keep=["id"]
    ).collect()
    for row in got:
        fields = python_parse(values[row.id], THREE)
        assert [row[n] for n in THREE.names] == fields, repr(values[row.id])
        assert row.hash == python_hash(fields), repr(values[row.id])


def test_hash_text_of_any_columns(spark):
    rng = random.Random(3)
    rows = [tuple("".join(rng.choices(ALPHABET, k=rng.randint(0, 6))) for _ in range(2)) for _ in range(300)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, b string")
    got = df.select("id", tuple_text(["a", "b"]).alias("t"), tuple_text(["a"]).alias("one")).collect()
    for r in got:
        assert r.t == str(rows[r.id])
        assert r.one == str((rows[r.id][0],))
    null = spark.sql("select cast(null as string) a").select(row_hash(["a"]).alias("h")).head()[0]
    assert null == python_hash([None])


def test_strip_equals_python(spark):
    rng = random.Random(5)
    values = ["".join(rng.choices(ALPHABET + [" "] * 6, k=8)) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    for r in df.select("id", strip(F.col("v")).alias("s")).collect():
        assert r.s == values[r.id].strip()


def test_line_breaks_equal_splitlines(spark):
    text = "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g" + chr(0x2028) + "h" + chr(0x2029) + "i"
    got = lines(spark, [text, "plain"]).select(F.explode(split_lines(F.col("value")))).collect()
    assert [r[0] for r in got] == text.splitlines() + ["plain"]


def test_undecodable_bytes(spark):
    raw = b"ab\xff\xc3(\xe2\x82cd"
    df = spark.createDataFrame([(bytearray(raw),)], "b binary").select(F.col("b").cast("string").alias("value"))
    assert explode_lines(df).head()[0] == raw.decode("utf-8", errors="replace")


def test_us_fl_layout():
    layout = layout_for("us_fl")
    at = {f.name: (f.start, f.end) for f in layout.fields}
    assert len(layout.fields) == 86
    assert at["COR_FILE_DATE"] == (473, 480) and at["STATE_COUNTRY"] == (504, 505)
    assert at["REPORT_DATE_1"] == (511, 518) and at["RA_NAME"] == (545, 586)
    assert at["PRINC1_TITLE"] == (669, 672) and at["PRINC1_ZIP4"] == (793, 796)
    assert at["PRINC6_ZIP4"] == (1433, 1436) and at["FILLER"] == (1437, 1440)


def test_render_and_parse_round_trip(spark):
    layout = layout_for("us_fl")
    row = {n: n[:2] if layout.fields[i].length >= 2 else "X" for i, n in enumerate(layout.names)}
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in layout.names))
    line = render_fixed_width(df, layout)
    assert len(line.head()[0]) == 1440
    assert parse_fixed_width(line, layout, add_hash=False).head().asDict() == row


def test_chunk_index(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.lit(999) - F.col("id")).alias("k"))
    got = with_chunk_index(df, 64, ["k"]).collect()
    assert {r.k: r.chunk_index for r in got} == {k: k // 64 for k in range(1000)}
    with pytest.raises(ValueError):
        with_chunk_index(df, 0, ["k"])


def test_chunk_index_with_one_hot_key(spark):
    df = spark.range(0, 3000, numPartitions=5).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    got = with_chunk_index(df, 100, ["k"])
    assert [r["count"] for r in got.groupBy("chunk_index").count().collect()] == [100] * 30
    assert got.filter("k = -1").agg(F.max("chunk_index")).head()[0] == 9


def test_numbered_lines(spark, tmp_path):
    for f in range(3):
        # Every tenth line break is one that only str.splitlines() knows.
        (tmp_path / f"f{f}.txt").write_text("".join(f"{f}-{i}" + ("\x0b" if i % 10 == 3 else "\n") for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        got = write_numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 1500
    assert all(r.value.split("-")[1] == str(r.row_index) for r in got)


def test_read_lines_from_file(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"one\r\ntwo\x0bthree\n\nfo\xffur")
    got = read_lines(spark, str(tmp_path / "x.txt"))
    expected = b"one\r\ntwo\x0bthree\n\nfo\xffur".decode("utf-8", "replace").splitlines()
    assert [r[0] for r in got.collect()] == expected


def test_parse_plan_is_narrow(spark):
    plan = parse_fixed_width(lines(spark, ["x"]), layout_for("us_fl"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
