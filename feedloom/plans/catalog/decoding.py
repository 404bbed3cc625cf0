"""Queries over the decoders."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.functions.json import Field, with_document
from feedloom.operators import decode
from feedloom.operators.framing import rows_of_pieces
from feedloom.plans.catalog.base import EVENTS_FEED, events_feed, query, table
from feedloom.sources import members
from feedloom.sources.files import numbered_lines


@query(
    "ndjson_rows",
    f"""WITH {EVENTS_FEED}, copies AS (SELECT unnest([0, 2, 3]) AS line)
    SELECT event_id, md5(CASE WHEN line = 2 THEN '{{"n":' || event_id || '}}' ELSE payload END) AS digest, CAST(count(*) AS BIGINT) AS copies
    FROM feed, copies GROUP BY ALL""",
)
def ndjson_rows(spark, sf_dir):
    # Blank lines, blanks around records and a last line without its newline.
    small = F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit("}"))
    bodies = events_feed(spark, sf_dir).withColumn(
        "body",
        F.concat("payload", F.lit("\n  \n  "), small, F.lit(" \r\n"), F.col("payload")),
    )
    rows = decode.decode_ndjson(bodies.select("event_id", "body"), "body", 1 << 20)
    return rows.groupBy("event_id", F.md5("payload").alias("digest")).agg(
        F.count(F.lit(1)).alias("copies")
    )


@query(
    "json_array_rows",
    """WITH parts AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents),
         flat AS (SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INT) AS pos, unnest(words) AS w FROM parts)
       SELECT doc_id, pos, md5(CAST(json_object('w', w) AS VARCHAR)) AS digest FROM flat""",
)
def json_array_rows(spark, sf_dir):
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("w")))
    bodies = table(spark, sf_dir, "documents").select("doc_id", F.to_json(words).alias("body"))
    rows = decode.explode_array(bodies, "body")
    return rows.select("doc_id", "pos", F.md5("payload").alias("digest"))


@query(
    "rows_at_pointer",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 3, 4) THEN 0 ELSE p END AS pos,
         CASE WHEN o_orderkey % 5 = 1 THEN o_orderkey * 10 + p END AS id,
         CASE o_orderkey % 5 WHEN 0 THEN 'pointer leads nowhere' WHEN 3 THEN 'pointer does not lead to an array'
              WHEN 4 THEN 'body is not JSON' END AS error
       FROM orders, (SELECT unnest([0, 1]) AS p)
       WHERE o_orderkey % 5 = 1 OR (o_orderkey % 5 IN (0, 3, 4) AND p = 0)""",
)
def rows_at_pointer(spark, sf_dir):
    # Rows under a key with a slash, an empty page (null), and three kinds of failure.
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    body = (
        F.when(kind == 0, F.lit('{"data":{}}'))
        .when(
            kind == 1,
            F.concat(
                F.lit('{"data":[{"a/b":[{"id":'), key, F.lit('0},{"id":'), key, F.lit("1}]}]}")
            ),
        )
        .when(kind == 2, F.lit('{"data":[{"a/b":null}]}'))
        .when(kind == 3, F.lit('{"data":[{"a/b":7}]}'))
        .otherwise(F.lit('{"data":['))
    )
    pages = table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    rows = decode.rows_at(pages, "body", "/data/0/a~1b", when_absent="fail")
    parsed = with_document(rows, "payload")
    return parsed.select(
        "o_orderkey", "pos", Field(F.col("_doc"), "id").number().cast("bigint").alias("id"), "error"
    )


@query(
    "rows_at_empty",
    """SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0""",
)
def rows_at_empty(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    body = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(F.lit('{"items":['), key, F.lit("]}"))
    ).otherwise(F.lit("{}"))
    pages = table(spark, sf_dir, "orders").select(body.alias("body"))
    rows = decode.rows_at(pages, "body", "/items", when_absent="empty")
    return rows.select(F.col("payload").cast("bigint").alias("o_orderkey"))


@query(
    "document_rows",
    """SELECT page_id, md5(regexp_replace(html, '^\\s+|\\s+$', '', 'g')) AS digest FROM pages
       WHERE page_id % 3 <> 0 AND regexp_replace(html, '^\\s+|\\s+$', '', 'g') <> ''""",
)
def document_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, F.lit(" \n ")).otherwise(F.col("html")).alias("body")
    )
    return decode.decode_document(pages, "body").select("page_id", F.md5("payload").alias("digest"))


@query(
    "json_rows",
    """SELECT event_id, p AS pos, CASE event_id % 4 WHEN 0 THEN event_id * 10 + p ELSE event_id END AS number
       FROM events, (SELECT unnest([0, 1]) AS p)
       WHERE event_id % 4 = 0 OR (event_id % 4 IN (1, 2) AND p = 0)""",
)
def json_rows(spark, sf_dir):
    key, kind = F.col("event_id").cast("string"), F.col("event_id") % 4
    body = (
        F.when(
            kind == 0,
            F.concat(F.lit("["), F.col("event_id") * 10, F.lit(","), F.col("event_id") * 10 + 1, F.lit("]")),
        )
        .when(kind == 1, F.concat(F.lit(" "), key))
        .when(kind == 2, F.concat(key, F.lit("\n")))
        .otherwise(F.lit("  "))
    )
    bodies = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return decode.decode_json(bodies, "body").select(
        "event_id", "pos", F.col("payload").cast("bigint").alias("number")
    )


_DOC_LINES = r"""lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw FROM documents),
     trimmed AS (SELECT doc_id, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM lines)"""


@query(
    "line_rows",
    f"""WITH {_DOC_LINES}
       SELECT doc_id, md5(line) AS digest, CAST(count(*) AS BIGINT) AS copies FROM trimmed WHERE line <> '' GROUP BY ALL""",
)
def line_rows(spark, sf_dir):
    rows = decode.decode_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    parsed = with_document(rows, "payload")
    return (
        parsed.select("doc_id", F.md5(Field(F.col("_doc"), "line").text()).alias("digest"))
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@query(
    "csv_rows",
    """SELECT c_custkey, CAST(p AS INT) AS pos, CASE WHEN p = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'short' END AS key,
         CASE WHEN p = 0 THEN c_name || ', "' || c_mktsegment || '"' || chr(10) || 'end' END AS name,
         CASE WHEN p = 0 THEN 'more' END AS extra, p = 1 AS is_short
       FROM customer, (SELECT unnest([0, 1]) AS p)""",
)
def csv_rows(spark, sf_dir):
    # Quoted quotes, commas and newlines, a field too many and a row too short.
    name = F.concat(
        "c_name", F.lit(', ""'), F.col("c_mktsegment"), F.lit('""\nend')
    )
    body = F.concat(
        F.lit("key,name\r\n"),
        F.col("c_custkey").cast("string"),
        F.lit(',"'),
        name,
        F.lit('",more\r\nshort\r\n'),
    )
    bodies = table(spark, sf_dir, "customer").select("c_custkey", body.alias("body"))
    parsed = with_document(decode.decode_csv(bodies, "body"), "payload")
    doc = F.col("_doc")
    return parsed.select(
        "c_custkey",
        "pos",
        Field(doc, "key").text().alias("key"),
        Field(doc, "name").text().alias("name"),
        Field(doc, "col_2").text().alias("extra"),
        (~Field(doc, "name").exists()).alias("is_short"),
    )


@query(
    "csv_large_field",
    """SELECT doc_id, CAST(p AS INT) AS pos, CASE p WHEN 0 THEN md5(repeat(text, 40)) WHEN 1 THEN md5('x') END AS digest,
         p = 2 AS failed FROM documents, (SELECT unnest([0, 1, 2]) AS p) WHERE p < 2 OR doc_id % 2 = 0""",
)
def csv_large_field(spark, sf_dir):
    """A field of forty texts, then a good row, then on half the bodies a quote that never ends."""
    quoted = F.concat(F.lit('"'), F.replace(F.repeat("text", 40), F.lit('"'), F.lit('""')), F.lit('"'))
    tail = F.when(F.col("doc_id") % 2 == 0, F.lit('2,"open\n')).otherwise(F.lit(""))
    bodies = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("key,value\n0,"), quoted, F.lit("\n1,x\n"), tail).alias("body")
    )
    rows = with_document(decode.decode_csv(bodies, "body"), "payload")
    failed = F.col("error").isNotNull()
    return rows.select(
        "doc_id",
        F.when(failed, F.lit(2)).otherwise(F.col("pos")).cast("int").alias("pos"),
        F.md5(Field(F.col("_doc"), "value").text()).alias("digest"),
        failed.alias("failed"),
    )


@query(
    "gzip_rows",
    f"""WITH {_DOC_LINES}
       SELECT doc_id, md5(line) AS digest, CAST(count(*) AS BIGINT) AS copies FROM trimmed WHERE line <> '' GROUP BY ALL""",
)
def gzip_rows(spark, sf_dir):
    # Two gzip members per document, or none at all: the magic decides, not the name.
    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = text.encode()
                half = len(data) // 2
                members = [data] if doc_id % 2 else [data[:half], data[half:]]
                if doc_id % 3 == 0:
                    packed.append(data)
                    continue
                out = b""
                for member in members:
                    deflater = zlib.compressobj(wbits=31)
                    out += deflater.compress(member) + deflater.flush()
                packed.append(out)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "content": packed})

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = documents.mapInPandas(squeeze, "doc_id long, content binary")
    texts = decode.inflate(files, "content").select(
        "doc_id", F.decode("content", "UTF-8").alias("body")
    )
    rows = decode.decode_ndjson(texts, "body")
    return rows.groupBy("doc_id", F.md5("payload").alias("digest")).agg(
        F.count(F.lit(1)).alias("copies")
    )


@query(
    "quoted_rows",
    f"""WITH {EVENTS_FEED} SELECT event_id, payload FROM feed""",
)
def quoted_rows(spark, sf_dir):
    quoted = F.to_json(F.array("payload"))
    rows = events_feed(spark, sf_dir).select(
        "event_id", quoted.substr(F.lit(2), F.length(quoted) - 2).alias("quoted")
    )
    return rows.select("event_id", decode.unquote(F.col("quoted")).alias("payload"))


@query(
    "decoder_of",
    """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'ndjson' WHEN 1 THEN 'ndjson' WHEN 2 THEN 'json' ELSE 'csv' END AS decoder FROM pages""",
)
def decoder_of(spark, sf_dir):
    endings = F.array(*[F.lit(x) for x in (".jsonl", ".ndjson.gz", ".JSON.gz", ".csv", ".CSV.gz")])
    name = F.concat(F.lit("/in/"), F.md5("url"), F.get(endings, (F.col("page_id") % 5).cast("int")))
    return table(spark, sf_dir, "pages").select("page_id", decode.decoder_of(name).alias("decoder"))


@query(
    "bounded_lines",
    """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
       SELECT doc_id, CAST(count(*) FILTER (WHERE strlen(line) <= 200) AS BIGINT) AS kept,
              CAST(count(*) FILTER (WHERE strlen(line) > 200) AS BIGINT) AS refused FROM lines GROUP BY doc_id""",
)
def bounded_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    kept, refused = decode.bound_lines(lines, "line", 200)
    both = kept.withColumn("ok", F.lit(True)).unionByName(refused.withColumn("ok", F.lit(False)))
    return both.groupBy("doc_id").agg(
        F.count_if("ok").alias("kept"), F.count_if(~F.col("ok")).alias("refused")
    )




# --- bodies over many tasks: 64 documents make a body, cut in chunks that end inside of rows ----------------


_BODY = "'body-' || doc_id // 64"
_SPLIT = f"""SELECT {_BODY} AS path, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1 AS pos,
       doc_id AS id, md5(text) AS digest FROM documents"""


def _body_pieces(spark, sf_dir, rows, sep, first, last):
    """Pieces of bodies whose rows are texts: `first` and `last` stand around them, chunks end within every fifth."""
    key = F.col("doc_id")
    body = Window.partitionBy("path").orderBy("doc_id")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("body-"), F.floor(key / 64)).alias("path"), rows.alias("row")
    )
    begins, ends = F.lag("doc_id").over(body).isNull(), F.lead("doc_id").over(body).isNull()
    text = F.concat(F.when(begins, F.lit(first)).otherwise(F.lit("")), "row", F.when(ends, F.lit(last)).otherwise(F.lit("")))
    split = documents.select("path", "doc_id", F.split(text, sep).alias("parts"))
    pieces = split.select("path", "doc_id", F.size("parts").alias("n"), F.posexplode("parts").alias("i", "value"))
    late = (F.col("i") * 2 >= F.col("n")).cast("int")
    return pieces.withColumn("chunk", F.floor((key * 2 + late) / 5).cast("long"))


@query("json_array_split", _SPLIT)
def json_array_split(spark, sf_dir):
    """Arrays of documents, cut at commas wherever they stand."""
    row = F.to_json(F.struct(F.col("doc_id").alias("id"), "text", F.array(F.lit("],[")).alias("also")))
    rows = rows_of_pieces(_body_pieces(spark, sf_dir, row, ",", "[", "]"), "json", order=["doc_id", "i"])
    parsed = with_document(rows, "payload")
    return parsed.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        Field(F.col("_doc"), "id").number().cast("bigint").alias("id"),
        F.md5(Field(F.col("_doc"), "text").text()).alias("digest"),
    )


@query("csv_split", _SPLIT)
def csv_split(spark, sf_dir):
    """The same as CSV with a header, cut at line breaks inside and outside of quotes."""
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    row = F.concat(F.col("doc_id").cast("string"), F.lit(","), quoted)
    rows = rows_of_pieces(_body_pieces(spark, sf_dir, row, "\n", "id,text\n", ""), "csv", order=["doc_id", "i"])
    parsed = with_document(rows, "payload")
    return parsed.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        Field(F.col("_doc"), "id").text().cast("bigint").alias("id"),
        F.md5(Field(F.col("_doc"), "text").text()).alias("digest"),
    )


@query("gzip_members", _SPLIT)
def gzip_members(spark, sf_dir):
    """The same as JSON lines in gzip bodies of two members a line, cut inside of it."""

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, doc_id, line in zip(batch["path"], batch["doc_id"], batch["line"], strict=True):
                data = line.encode() + b"\n"
                for m, half in enumerate((data[: len(data) // 3], data[len(data) // 3 :])):
                    deflater = zlib.compressobj(wbits=31)
                    packed = deflater.compress(half) + deflater.flush()
                    parts = packed.split(members.MAGIC)[1:]
                    rows += [(path, doc_id, (doc_id * 2 + m) // 3, m, i, p) for i, p in enumerate(parts)]
            yield pd.DataFrame(rows, columns=["path", "doc_id", "chunk", "m", "i", "value"])

    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("body-"), F.floor(F.col("doc_id") / 64)).alias("path"),
        "doc_id",
        F.to_json(F.struct(F.col("doc_id").alias("id"), "text")).alias("line"),
    )
    pieces = documents.mapInPandas(squeeze, "path string, doc_id long, chunk long, m int, i int, value binary")
    # a range's number is its first byte; only a body's first begins with 0
    pieces = pieces.withColumn("chunk", F.col("chunk") + 1)
    pieces = pieces.repartition("path", "chunk").sortWithinPartitions("path", "chunk", "doc_id", "m", "i")
    lines = members.member_pieces(members.members(pieces), "\n")
    rows = numbered_lines(lines.withColumnRenamed("value", "payload").withColumnRenamed("i", "_id"))
    parsed = with_document(rows, "payload")
    return parsed.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        Field(F.col("_doc"), "id").number().cast("bigint").alias("id"),
        F.md5(Field(F.col("_doc"), "text").text()).alias("digest"),
    )
