"""Column functions over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from dayfold import functions as D
from dayfold.queries.tables import read


def batch_date(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", D.batch_date(F.col("o_orderdate")).alias("dt")
    )


def csv_list(spark, sf_dir):
    items = D.csv_list(F.col("text"))
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(items, "|").alias("items")
    )


def csv_map(spark, sf_dir):
    text = F.concat(
        F.lit("name: "), "p_name", F.lit(" , brand :"), "p_brand", F.lit(",type:"), "p_type",
        F.lit(":rest,name:"), "p_size", F.lit(", ,"),
    )
    entries = F.array_sort(F.map_entries(D.csv_map(text)))
    pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(pairs, ";").alias("pairs"))


def replace_suffix(spark, sf_dir):
    name = F.concat("c_name", F.lit(".csv"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", D.replace_suffix(name, ".csv", ".txt").alias("file_name")
    )


def json_escape(spark, sf_dir):
    # Every control character is in the text of some documents.
    low = F.char(1 + F.col("doc_id") % 31)
    high = F.char(127 + F.col("doc_id") % 33)
    return read(spark, sf_dir, "documents").select(
        "doc_id", D.json_escape(F.concat("text", low, F.lit('"/\\'), high)).alias("escaped")
    )


def json_escape_pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id", D.json_escape(F.col("html")).alias("escaped")
    )


def safe_abs(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 5 == 0, F.lit(-(2**31))).otherwise(
        (F.col("o_custkey") % 1400 - 700).cast("int")
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", D.safe_abs(value).alias("size"))


def row_hash(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    columns = ["c_name", "c_custkey", "c_nationkey"]
    return customer.select("c_custkey", D.row_hash(customer, columns).alias("hash"))


def row_hash_text(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return documents.select("doc_id", D.row_hash(documents, ["text"]).alias("hash"))


def row_hash_typed(spark, sf_dir):
    """Hash of a double, a decimal, a day and a timestamp."""
    price = F.col("l_extendedprice")
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("price"), (-price).cast("decimal(20,4)").alias("owed"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("time"),
    )
    columns = ["price", "owed", "day", "time"]
    return items.select("l_orderkey", "l_linenumber", D.row_hash(items, columns).alias("hash"))


def row_hash_nested(spark, sf_dir):
    """Hash of the list of a text's words, and of a struct."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.split("text", " ").alias("words"), F.struct("lang", "n_chars").alias("about")
    )
    return docs.select("doc_id", D.row_hash(docs, ["words", "about"]).alias("hash"))


def _words(spark, sf_dir):
    """Orders with a number that does not fit 32 bits, and its four bytes."""
    number = F.col("o_orderkey") % 1000003 * F.lit(4294967) + F.col("o_orderkey") % 977
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", D.encode_u32(number).alias("word")
    )


def encode_u32(spark, sf_dir):
    return _words(spark, sf_dir).select("o_orderkey", F.hex("word").alias("word"))


def decode_u32(spark, sf_dir):
    return _words(spark, sf_dir).select("o_orderkey", D.decode_u32(F.col("word")).alias("number"))


def decode_i32(spark, sf_dir):
    framed = F.concat(F.unhex(F.lit("FF00")), "word")
    return _words(spark, sf_dir).select("o_orderkey", D.decode_i32(framed, 2).alias("number"))


def byte_slice(spark, sf_dir):
    digits = D.byte_slice(F.col("c_name").cast("binary"), 9, 9)
    return read(spark, sf_dir, "customer").select(
        "c_custkey", digits.cast("string").alias("digits")
    )


def bytes_to_text(spark, sf_dir):
    raw = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF41")))
    return read(spark, sf_dir, "documents").select(
        "doc_id", D.bytes_to_text(raw).alias("text")
    )


def bytes_to_text_wide(spark, sf_dir):
    """Text through two wide charsets: one byte order is given, the other is marked."""
    text = F.col("text")
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        D.bytes_to_text(F.encode(text, "UTF-16LE"), "UTF-16LE").alias("little"),
        D.bytes_to_text(F.encode(text, "UTF-16"), "UTF-16").alias("marked"),
    )


def put_u32(spark, sf_dir):
    """Four bytes of each customer's name replaced by the customer's number."""
    name = F.col("c_name").cast("binary")
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.hex(D.put_u32(name, 4, F.col("c_custkey"))).alias("bytes")
    )


def bytes_equal(spark, sf_dir):
    def last(name):
        return D.byte_slice(D.encode_u32(F.col(name)), 3, 1)

    return read(spark, sf_dir, "orders").select(
        "o_orderkey", D.bytes_equal(last("o_orderkey"), last("o_custkey")).alias("same")
    )


QUERIES = {
    "batch_date": batch_date,
    "csv_list": csv_list,
    "csv_map": csv_map,
    "replace_suffix": replace_suffix,
    "json_escape": json_escape,
    "json_escape_pages": json_escape_pages,
    "safe_abs": safe_abs,
    "row_hash": row_hash,
    "row_hash_text": row_hash_text,
    "row_hash_typed": row_hash_typed,
    "row_hash_nested": row_hash_nested,
    "encode_u32": encode_u32,
    "decode_u32": decode_u32,
    "decode_i32": decode_i32,
    "byte_slice": byte_slice,
    "bytes_to_text": bytes_to_text,
    "bytes_to_text_wide": bytes_to_text_wide,
    "put_u32": put_u32,
    "bytes_equal": bytes_equal,
}


def _escape_sql(text):
    quoted = {"chr(92)": "\\\\", "'\"'": '\\"', "'/'": "\\/"}
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    quoted |= {f"chr({code})": escape for code, escape in short.items()}
    coded = [c for c in [*range(1, 32), *range(127, 160)] if c not in short]
    quoted |= {f"chr({code})": f"\\u{code:04x}" for code in coded}
    return reduce(lambda sql, item: f"replace({sql}, {item[0]}, '{item[1]}')", quoted.items(), text)


def _string_hash_sql(text):
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    return f"list_reduce(list_prepend(0::BIGINT, {codes}), lambda h, c: (h * 31 + c) % 4294967296)"


def _signed_sql(value):
    return f"(CASE WHEN {value} > 2147483647 THEN {value} - 4294967296 ELSE {value} END)::INTEGER"


def _long_hash_sql(value):
    """Of a number or a sum of bits that is not negative."""
    return f"(xor({value}, {value} >> 32) % 4294967296)"


def _fold_sql(start, items):
    return (
        f"list_reduce(list_prepend({start}::BIGINT, {items}), "
        "lambda h, c: (h * 31 + c) % 4294967296)"
    )


NUMBER_SQL = "((o_orderkey % 1000003 * 4294967 + o_orderkey % 977) % 4294967296)"
SPACE_SQL = "[ \\t\\n\\x0B\\f\\r]*"

ORACLES = {
    "batch_date": """
        SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS dt FROM orders""",
    "csv_list": f"""
        SELECT doc_id, array_to_string(list_filter(
            regexp_split_to_array(text, '{SPACE_SQL},{SPACE_SQL}'),
            lambda item: item <> ''), '|') AS items
        FROM documents""",
    "csv_map": """
        SELECT p_partkey,
          'brand=' || p_brand || ';name=' || p_size || ';type=' || p_type AS pairs FROM part""",
    "replace_suffix": "SELECT c_custkey, c_name || '.txt' AS file_name FROM customer",
    "json_escape": f"""
        SELECT doc_id, {_escape_sql("text")} AS escaped FROM (
          SELECT doc_id, text || chr((1 + doc_id % 31)::INTEGER) || '"/' || chr(92)
            || chr((127 + doc_id % 33)::INTEGER) AS text FROM documents)""",
    "json_escape_pages": f"SELECT page_id, {_escape_sql('html')} AS escaped FROM pages",
    "safe_abs": """
        SELECT o_orderkey, (CASE WHEN o_orderkey % 5 = 0 THEN 0
          ELSE abs(o_custkey % 1400 - 700) END)::INTEGER AS size FROM orders""",
    "row_hash": f"""
        SELECT c_custkey, {_signed_sql("hash")} AS hash FROM (
          SELECT c_custkey, ((((31 + {_string_hash_sql("c_name")}) % 4294967296) * 31
            + xor(c_custkey, c_custkey >> 32) % 4294967296) % 4294967296 * 31
            + c_nationkey) % 4294967296 AS hash FROM customer)""",
    "row_hash_text": f"""
        SELECT doc_id, {_signed_sql("hash")} AS hash FROM (
          SELECT doc_id, (31 + {_string_hash_sql("text")}) % 4294967296 AS hash
          FROM documents)""",
    "row_hash_typed": f"""
        SELECT l_orderkey, l_linenumber, {_signed_sql("hash")} AS hash FROM (
          SELECT l_orderkey, l_linenumber, {_fold_sql(1, f"""[
            {_long_hash_sql("bits")},
            ((4294967296 - (cents // 4294967296 * 31 + cents % 4294967296) % 4294967296) * 31
              + 4) % 4294967296,
            {_long_hash_sql("millis")}, {_long_hash_sql("millis")}]""")} AS hash
          FROM (
            SELECT l_orderkey, l_linenumber,
              (power + 1023)::BIGINT * 4503599627370496
                + ((l_extendedprice / pow(2, power) - 1) * 4503599627370496)::BIGINT AS bits,
              (l_extendedprice::DECIMAL(20, 4) * 10000)::BIGINT AS cents,
              epoch_ms(l_shipdate::DATE::TIMESTAMP) AS millis
            FROM (SELECT *, floor(log2(l_extendedprice)) AS power FROM lineitem)))""",
    "row_hash_nested": f"""
        SELECT doc_id, {_signed_sql("hash")} AS hash FROM (
          SELECT doc_id, {_fold_sql(1, f"""[
            {_fold_sql(1, f"list_transform(string_split(text, ' '), lambda w: {_string_hash_sql('w')})")},
            {_fold_sql(1, f"[{_string_hash_sql('lang')}, {_long_hash_sql('n_chars::BIGINT')}]")}
          ]""")} AS hash FROM documents)""",
    "encode_u32": f"SELECT o_orderkey, printf('%08X', {NUMBER_SQL}) AS word FROM orders",
    "decode_u32": f"SELECT o_orderkey, {NUMBER_SQL} AS number FROM orders",
    "decode_i32": f"""
        SELECT o_orderkey, {_signed_sql("n")} AS number FROM (
          SELECT o_orderkey, {NUMBER_SQL} AS n FROM orders)""",
    "byte_slice": "SELECT c_custkey, substr(c_name, 10, 9) AS digits FROM customer",
    "bytes_to_text": "SELECT doc_id, text || chr(65533) || 'A' AS text FROM documents",
    "bytes_to_text_wide": "SELECT doc_id, text AS little, text AS marked FROM documents",
    "put_u32": """
        SELECT c_custkey, hex(encode(substr(c_name, 1, 4))) || printf('%08X', c_custkey)
          || hex(encode(substr(c_name, 9))) AS bytes FROM customer""",
    "bytes_equal": """
        SELECT o_orderkey, o_orderkey % 256 = o_custkey % 256 AS same FROM orders""",
}
