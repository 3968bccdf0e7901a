"""Column functions: edge cases, and random input against plain Python."""

import math
import random
import re
import struct
from datetime import date, datetime, timedelta
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from dayfold import functions as D
from dayfold.functions.dates import compact_day, day_bounds, require_day
from dayfold.functions.hashing import hash_values


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, function, values, kind="string"):
    rows = column(spark, values, kind).select("i", function(F.col("v")).alias("r"))
    return [r["r"] for r in rows.orderBy("i").collect()]


def random_texts(alphabet, count, longest, seed):
    chooser = random.Random(seed)
    return [
        "".join(chooser.choice(alphabet) for _ in range(chooser.randrange(longest)))
        for _ in range(count)
    ]


def test_null_or_empty(spark):
    assert apply(spark, D.null_or_empty, [None, "", " ", "a"]) == [True, True, False, False]


def test_csv_list(spark):
    values = [",a , b,,", None, "", " a , b,,c ", " , ", "a"]
    assert apply(spark, D.csv_list, values) == [
        ["a", "b"], [], [], [" a", "b", "c "], [], ["a"],
    ]


def test_csv_list_random(spark):
    texts = random_texts("ab, \t\n", 300, 14, 1)
    expected = [[p for p in re.split(r"\s*,\s*", t) if p] if t else [] for t in texts]
    assert apply(spark, D.csv_list, texts) == expected


def test_csv_list_long_runs_stay_linear(spark):
    text = "a" + " " * 300_000 + "b , c" + "\t" * 300_000
    assert apply(spark, D.csv_list, [text]) == [["a" + " " * 300_000 + "b", "c" + "\t" * 300_000]]


def test_csv_map(spark):
    values = ["a : 1 ,b:2", "a:1,a:2:9, , ", "", " a:1", "a::b", ":1", ",", " , ,"]
    assert apply(spark, D.csv_map, values) == [
        {"a": "1", "b": "2"}, {"a": "2"}, {}, {" a": "1"}, {"a": ""}, {"": "1"}, {}, {},
    ]


@pytest.mark.parametrize("bad", ["a", "a:", "a:1,,b:2", ",a:1", None, "  ", ":", "a: :"])
def test_csv_map_error(spark, bad):
    with pytest.raises(Exception, match="not a key:value pair|csv_map of null"):
        apply(spark, D.csv_map, [bad])


def _drop_trailing(items):
    while items and items[-1] == "":
        items.pop()
    return items


def _python_map(text):
    """The map, or None where the text is an error."""
    if text == "":
        return {}
    result = {}
    for item in _drop_trailing(re.split(r"\s*,\s*", text)):
        parts = _drop_trailing(re.split(r"\s*:\s*", item)) if item else [""]
        if len(parts) < 2:
            return None
        result[parts[0]] = parts[1]
    return result


def test_csv_map_random(spark):
    texts = random_texts("ab,:: \t", 4000, 12, 2)
    good = [t for t in texts if _python_map(t) is not None]
    assert len(good) > 150
    assert apply(spark, D.csv_map, good) == [_python_map(t) for t in good]


def test_csv_map_long_runs_stay_linear(spark):
    text = "k:v" + " , " * 50_000 + "x:y"
    with pytest.raises(Exception, match="not a key:value pair"):
        apply(spark, D.csv_map, [text])
    assert apply(spark, D.csv_map, ["k:v" + " , " * 50_000]) == [{"k": "v"}]


def test_replace_suffix(spark):
    def swap(c):
        return D.replace_suffix(c, ".csv", ".txt")

    assert apply(spark, swap, ["a.csv", ".csv", "é.csv.csv"]) == ["a.txt", ".txt", "é.csv.txt"]
    for bad in ("a.txt", "a.csv ", None):
        with pytest.raises(Exception, match="expected text that ends with"):
            apply(spark, swap, [bad])


def _python_escape(text):
    short = {'"': '\\"', "\\": "\\\\", "/": "\\/", "\b": "\\b", "\f": "\\f", "\n": "\\n",
             "\r": "\\r", "\t": "\\t"}
    return "".join(
        short.get(c) or (f"\\u{ord(c):04x}" if ord(c) < 32 or 127 <= ord(c) < 160 else c)
        for c in text
    )


def test_json_escape(spark):
    assert apply(spark, D.json_escape, ['a/"\\\n\x01\x7f\x85', None, ""]) == [
        'a\\/\\"\\\\\\n\\u0001\\u007f\\u0085', None, "",
    ]
    every = [chr(code) for code in range(0, 0x180)] + ["€😀\x1f\\u0001"]
    texts = every + random_texts('ab/"\\\b\f\n\r\t\x00\x01\x7f\x85é😀', 300, 30, 3)
    assert apply(spark, D.json_escape, texts) == [_python_escape(t) for t in texts]


def test_safe_abs(spark):
    values = [-(2**31), -(2**31) + 1, -5, 0, 7, None]
    assert apply(spark, D.safe_abs, values, "int") == [0, 2**31 - 1, 5, 0, 7, None]


def _signed(h):
    h &= 0xFFFFFFFF
    return h - 2**32 if h >= 2**31 else h


def _python_hash(items):
    h = 1
    for item in items:
        if item is None:
            continue
        if isinstance(item, bool):
            code = 1231 if item else 1237
        elif isinstance(item, int):
            code = (item & (2**64 - 1)) ^ ((item & (2**64 - 1)) >> 32)
        else:
            raw = item.encode("utf-16-be")
            code = 0
            for i in range(0, len(raw), 2):
                code = (31 * code + raw[i] * 256 + raw[i + 1]) & 0xFFFFFFFF
        h = 31 * h + code
    return _signed(h)


def test_row_hash_values(spark):
    frame = spark.createDataFrame(
        [("hello",), ("",), (None,)], "s string"
    )
    hashes = [r[0] for r in frame.select(D.row_hash(frame, ["s"])).collect()]
    assert hashes == [_signed(31 + 99162322), 31, 1]
    longs = spark.createDataFrame([(5000000000,), (-1,), (7,)], "n long")
    assert [r[0] for r in longs.select(D.row_hash(longs, ["n"])).collect()] == [
        _signed(31 + 705032705), 31, 38,
    ]
    assert longs.select(D.row_hash(longs, [])).first()[0] == 1


def test_row_hash_random(spark):
    chooser = random.Random(4)
    texts = random_texts("ab é€😀\n", 300, 40, 5)
    rows = [
        (
            chooser.choice([None, *texts]),
            chooser.choice([None, chooser.randrange(-(2**63), 2**63)]),
            chooser.choice([None, True, False]),
        )
        for _ in range(300)
    ]
    frame = spark.createDataFrame(rows, "s string, n long, b boolean").coalesce(1)
    actual = frame.select("s", "n", "b", D.row_hash(frame, ["s", "n", "b"]).alias("h")).collect()
    assert [r["h"] for r in actual] == [_python_hash((r["s"], r["n"], r["b"])) for r in actual]


def test_row_hash_int_and_unsupported(spark):
    frame = spark.createDataFrame([(-1, 2)], "i int, s short")
    assert frame.select(D.row_hash(frame, ["i", "s"])).first()[0] == _signed((31 - 1) * 31 + 2)
    for kind in ("interval day to second", "array<struct<a: interval day to second>>"):
        with pytest.raises(TypeError, match="interval"):
            D.row_hash(frame.withColumn("d", F.lit(None).cast(kind)), ["d"])


def hash_of(spark, kind, values):
    """The hash of each value of a type by itself, 0 for null."""
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}").coalesce(1)
    found = frame.select("i", "v", D.row_hash(frame, ["v"]).alias("h")).orderBy("i").collect()
    return [_signed(r["h"] - 31) if r["v"] is not None else 0 for r in found]


def test_number_hashes_equal_the_jvm(spark):
    jvm_hash, chooser = spark.sparkContext._jvm.java.util.Objects.hashCode, random.Random(8)
    doubles = [0.0, -0.0, 1.5, -2.25, math.inf, -math.inf, math.nan, 5e-324, 1.7e308, 1e-310]
    doubles += [chooser.gauss(0, 1) * 10 ** chooser.randrange(-30, 30) for _ in range(40)]
    assert hash_of(spark, "double", doubles) == list(map(jvm_hash, doubles))
    floats = [float(np.float32(d)) for d in doubles if abs(d) < 1e30 or d != d]
    bits = [struct.unpack("<i", struct.pack("<f", d))[0] if d == d else 0x7FC00000 for d in floats]
    assert hash_of(spark, "float", floats) == bits
    digits = [chooser.randrange(1, 38) for _ in range(60)]
    numbers = [chooser.choice([-1, 1]) * chooser.randrange(10**d) for d in digits]
    numbers += [0, 1, -1, 2**32, -(2**32), 2**64, 2**64 - 1, -(2**64), 10**38 - 1, 1 - 10**38]
    with localcontext(prec=40):
        decimals = [Decimal(n).scaleb(-6) for n in numbers]
    assert hash_of(spark, "decimal(38, 6)", decimals) == list(map(jvm_hash, decimals))


def test_time_and_nested_hashes(spark):
    util = spark.sparkContext._jvm.java.util

    def millis_hash(millis):
        return util.Date(millis).hashCode()

    days = [date(1970, 1, 1), date(1969, 12, 31), None, date(2024, 2, 29), date(1, 1, 1)]
    epoch = date(1970, 1, 1)
    assert hash_of(spark, "date", days) == [
        0 if d is None else millis_hash((d - epoch).days * 86_400_000) for d in days
    ]
    moments = [datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(2024, 5, 6, 7, 8, 9, 123_456)]
    expected = [millis_hash((m - datetime(1970, 1, 1)) // timedelta(milliseconds=1)) for m in moments]
    assert hash_of(spark, "timestamp_ntz", moments) == expected
    assert hash_of(spark, "binary", [b"", b"\xff\x01", None]) == [1, (31 - 1) * 31 + 1, 0]
    lists = [["a", None, "hello"], [], None, ["", "é😀"], *[["word"] * n for n in range(700)]]

    def list_hash(items):
        made = util.ArrayList()
        for item in items:
            made.add(item)
        return made.hashCode()

    expected = [0 if v is None else list_hash(v) for v in lists]
    assert hash_of(spark, "array<string>", lists) == expected
    nested = [[[1, 2], None, []], [[3]], None, [None]]
    assert hash_of(spark, "array<array<int>>", nested) == [
        _signed(((31 + 994) * 31 + 0) * 31 + 1), 31 + 34, 0, 31,
    ]
    rows = [(1, None, "hello"), (None, None, None), None]
    assert hash_of(spark, "struct<a: int, b: double, c: string>", rows) == [
        _signed((31 + 1) * 31 + 99162322), 1, 0,
    ]
    maps = [{"a": 1, "hello": 7}, {"hello": 7, "a": 1}, {}, None, {"b": None}]
    both = _signed((97 ^ 1) + (99162322 ^ 7))
    assert hash_of(spark, "map<string, int>", maps) == [both, both, 0, 0, 98]
    assert hash_of(spark, "array<double>", []) == []


def test_hash_of_parts_of_arrays():
    whole = pa.array([{"k": [Decimal("-1.50"), None], "m": [("x", True)]}, None, {"k": [], "m": []}] * 3,
                     pa.struct([("k", pa.list_(pa.decimal128(9, 2))),
                                ("m", pa.map_(pa.string(), pa.bool_()))]))
    expected = hash_values(whole).tolist()
    assert expected[:3] == expected[3:6] and expected[1] == 0
    for start in range(9):
        assert hash_values(whole.slice(start, 3)).tolist() == expected[start : start + 3]


def binary(spark, *values):
    schema = StructType([StructField("b", BinaryType()), StructField("s", StringType())])
    return spark.createDataFrame([(v, None) for v in values], schema)


def test_integers_in_bytes(spark):
    frame = binary(spark, bytes.fromhex("FFFFFFFE"))
    assert frame.select(D.decode_u32(F.col("b"))).first()[0] == 4294967294
    assert frame.select(D.decode_i32(F.col("b"))).first()[0] == -2
    frame = binary(spark, bytes.fromhex("00007FFFFFFF"))
    assert frame.select(D.decode_i32(F.col("b"), 2)).first()[0] == 2**31 - 1
    values = [8589934593, -1, 0, 2**31, None]
    encoded = apply(spark, D.encode_u32, values, "long")
    assert [None if e is None else bytes(e).hex() for e in encoded] == [
        "00000001", "ffffffff", "00000000", "80000000", None,
    ]
    frame = binary(spark, bytes(6))
    put = frame.select(D.put_u32(F.col("b"), 1, F.lit(0x01020304))).first()[0]
    assert bytes(put) == bytes([0, 1, 2, 3, 4, 0])


def test_bytes_out_of_range(spark):
    frame = binary(spark, b"abc")
    for bad in (
        D.decode_u32(F.col("b")),
        D.byte_slice(F.col("b"), 2, 2),
        D.put_u32(F.col("b"), 0, F.lit(1)),
    ):
        with pytest.raises(Exception, match="asked of a value of 3"):
            frame.select(bad).collect()
    with pytest.raises(ValueError, match="negative"):
        D.byte_slice(F.col("b"), -1, 1)


def test_byte_slice_and_equality(spark):
    frame = binary(spark, b"abcdef", None)
    assert [r[0] for r in frame.select(D.byte_slice(F.col("b"), 2, 3)).collect()] == [b"cde", None]
    same = D.bytes_equal(F.col("b"), F.lit("abcdef").cast("binary"))
    assert [r[0] for r in frame.select(same).collect()] == [True, None]


@pytest.mark.parametrize(
    ("raw", "charset", "text"),
    [
        (b"\x41\xff\x42", "UTF-8", "A�B"),
        ("é€😀".encode(), "utf-8", "é€😀"),
        (b"A\xe9\x80B", "US-ASCII", "A��B"),
        (b"A\xe9", "ISO-8859-1", "Aé"),
        ("é😀".encode("utf-16-be"), "UTF-16BE", "é😀"),
        ("é😀".encode("utf-16-be"), "UTF-16", "é😀"),
        ("é😀".encode("utf-16"), "UTF-16", "é😀"),
        (b"\xd8\x00", "UTF-16BE", "�"),
        ("漢字".encode("gbk") + b"\xff", "GBK", "漢字�"),
    ],
)
def test_bytes_to_text(spark, raw, charset, text):
    assert binary(spark, raw).select(D.bytes_to_text(F.col("b"), charset)).first()[0] == text


def test_bytes_to_text_of_an_unknown_charset(spark):
    with pytest.raises(LookupError):
        D.bytes_to_text(F.col("b"), "no-such-charset")


def test_batch_date(spark):
    dates = [date(2024, 3, 1), date(2024, 1, 1), None]
    assert apply(spark, D.batch_date, dates, "date") == ["20240229", "20231231", None]
    assert D.resolve_batch_date([], date(2024, 3, 1)) == "20240229"
    assert D.resolve_batch_date(["20160801", "x"]) == "20160801"
    assert re.fullmatch(r"\d{8}", D.resolve_batch_date())


def test_compact_day_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS t")
        assert frame.select(compact_day(F.col("t"))).first()[0] == "20240310"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("bad", ["2016-08-10", "201608", "20161301", "", "020160801", "２０１６０８０１"])
def test_days_are_validated(bad):
    with pytest.raises(ValueError):
        require_day(bad)


def test_day_bounds():
    assert day_bounds("20240229") == ("2024-02-29 00:00:00", "2024-03-01 00:00:00")
