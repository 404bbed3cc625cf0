"""Queries over captured page sequences; every order is one page of its customer's sequence."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.functions.json import at_pointer, pointer_text
from feedloom.operators import paging
from feedloom.plans.catalog.base import query, table

SEQ = ["seq_key"]


def _pages(spark, sf_dir):
    key = F.col("o_orderkey")
    text = key.cast("string")
    ends = key % 7 == 0
    rows = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(i.alias("id")))
    rows = F.slice(rows, 1, F.when(key % 9 == 0, (key % 3).cast("int")).otherwise(3))
    token = (
        F.when(ends, F.lit(""))
        .when(key % 5 == 0, F.lit("again"))
        .otherwise(F.concat(F.lit("t"), text))
    )
    body = F.to_json(
        F.struct(
            rows.alias("rows"),
            token.alias("next"),
            (F.col("o_custkey") % 6 + 1).alias("pages"),
            F.when(F.col("o_custkey") % 5 != 0, F.lit(20)).alias("total"),
            F.when(key % 13 == 0, F.lit(True)).otherwise(F.lit(False)).alias("failed"),
            F.concat(F.lit("why-"), text).alias("reason"),
        )
    )
    link = F.concat(
        F.lit('<https://h/x?p='), text, F.lit('>; rel="prev"'),
        F.when(ends, F.lit("")).otherwise(F.concat(F.lit(', <https://h/y?p='), text, F.lit('>; title=z; rel=next'))),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("seq_key"),
        key.alias("page_id"),
        F.concat(F.lit("https://h/api/list?p="), text).alias("url"),
        F.create_map(
            F.lit("LINK"), link,
            F.lit("X-Next"), F.when(ends, F.lit("")).otherwise(F.concat(F.lit("more?p="), text)),
            F.lit("X-Remaining"), (key % 1000).cast("string"),
        ).alias("headers"),
        body.alias("body"),
    )


def _assembled(spark, sf_dir, pager, max_pages=1000, strict=True):
    out = paging.assemble_pages(_pages(spark, sf_dir), SEQ, pager, max_pages, strict)
    return out.select("seq_key", "page_id", F.col("page_no").cast("bigint").alias("page_no"), "status")


def _oracle(ends: str, loop: str = "false", limit: int = 1000, over: str = "ceiling") -> str:
    return f"""WITH p AS (SELECT o_custkey AS seq_key, o_orderkey AS page_id, *,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS page_no,
         CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 3 ELSE 3 END AS n_rows,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'again' ELSE 't' || o_orderkey END AS token
         FROM orders),
       q AS (SELECT *, sum(n_rows) OVER (PARTITION BY seq_key ORDER BY page_id) AS upto,
               lag(token) OVER (PARTITION BY seq_key ORDER BY page_id) AS asked FROM p),
       j AS (SELECT *, coalesce({ends}, false) AS ends, coalesce({loop}, false) AND NOT coalesce({ends}, false) AS loops FROM q),
       f AS (SELECT seq_key, min(page_no) FILTER (WHERE ends OR loops) AS first_end,
               min(page_no) FILTER (WHERE loops) AS first_loop, max(page_no) AS last_no FROM j GROUP BY seq_key)
       SELECT j.seq_key, page_id, CAST(page_no AS BIGINT) AS page_no,
         CASE WHEN coalesce(first_end, last_no) >= {limit} THEN '{over}' WHEN first_end IS NULL THEN 'open'
              WHEN first_loop = first_end THEN 'loop' ELSE 'complete' END AS status
       FROM j JOIN f USING (seq_key) WHERE page_no <= least(coalesce(first_end, last_no), {limit - 1})"""


@query("single_page", _oracle("true"))
def single_page(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("none"))


@query("link_next", _oracle("page_id % 7 = 0"))
def link_next(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("link_header"))


@query("token_pages", _oracle("token IS NULL", "token = asked"))
def token_pages(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("cursor", at="/next"))


@query("token_pages_stop", _oracle("token IS NULL OR page_id % 13 = 0", "token = asked"))
def token_pages_stop(spark, sf_dir):
    failed = pointer_text(F.col("body"), "/failed") == "true"
    return _assembled(spark, sf_dir, paging.Pager("cursor", at="/next", stop_when=failed))


@query("numbered_pages", _oracle("page_no + 1 >= seq_key % 6 + 1"))
def numbered_pages(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("page_number", total_at="/pages", start=1))


@query("numbered_pages_empty", _oracle("n_rows = 0"))
def numbered_pages_empty(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("page_number", rows_at="/rows"))


@query("offset_pages", _oracle("n_rows = 0 OR n_rows < 3 OR seq_key % 5 = 0 OR upto >= 20"))
def offset_pages(spark, sf_dir):
    return _assembled(
        spark, sf_dir, paging.Pager("offset", total_at="/total", rows_at="/rows", page_size=3)
    )


@query("url_pages", _oracle("page_id % 7 = 0"))
def url_pages(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("request_path", header="x-next"))


@query(
    "url_pages_base",
    """SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0
         THEN 'https://h/api/v2/items?p=' || o_orderkey ELSE 'http://other/x?p=' || o_orderkey END AS following FROM orders""",
)
def url_pages_base(spark, sf_dir):
    """Next URLs under a configured base: joined with one slash, or whole."""
    key = F.col("o_orderkey")
    slash = F.when(key % 4 == 0, F.lit("/items?p=")).otherwise(F.lit("items?p="))
    link = F.when(key % 2 == 0, F.concat(slash, key)).otherwise(F.concat(F.lit("http://other/x?p="), key))
    return table(spark, sf_dir, "orders").select(
        key.alias("page_id"),
        paging.join_base(F.lit("https://h/api/v2/"), F.when(key % 7 != 0, link)).alias("following"),
    )


@query(
    "pages_repeated_keys",
    """WITH p AS (SELECT o_custkey AS seq_key, o_orderkey AS page_id,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS page_no FROM orders),
       e AS (SELECT seq_key, min(page_no) FILTER (WHERE page_id % 7 = 0) AS stop FROM p GROUP BY seq_key)
       SELECT seq_key, page_id, page_id AS id, 'last' AS kind FROM p JOIN e USING (seq_key) WHERE page_no <= coalesce(stop, 1000000)""",
)
def pages_repeated_keys(spark, sf_dir):
    """Bodies whose rows and tokens repeat keys, nested ones too: the last one counts."""
    from feedloom.functions.json import Field, with_document
    from feedloom.operators.decode import rows_at

    key = F.col("o_orderkey").cast("string")
    token = F.when(F.col("o_orderkey") % 7 == 0, F.lit("null")).otherwise(F.concat(F.lit('"t'), key, F.lit('"')))
    row = F.concat(F.lit('{"a":{"k":"first","k":"last"},"id":0,"id":'), key, F.lit("}"))
    pages = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("seq_key"),
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.lit('{"rows":['), row, F.lit('],"next":"x","next":'), token, F.lit("}")).alias("body"),
    )
    kept = paging.assemble_pages(pages, SEQ, paging.Pager("cursor", at="/next"), 1000)
    rows = with_document(rows_at(kept, "body", "/rows", strict=True), "payload")
    return rows.select(
        "seq_key",
        "page_id",
        Field(F.col("_doc"), "id").number().cast("bigint").alias("id"),
        Field(F.col("_doc"), "a.k").text().alias("kind"),
    )


@query("page_ceiling", _oracle("page_id % 7 = 0", limit=4))
def page_ceiling(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("link_header"), max_pages=4)


@query("page_cut", _oracle("page_id % 7 = 0", limit=4, over="cut"))
def page_cut(spark, sf_dir):
    return _assembled(spark, sf_dir, paging.Pager("link_header"), max_pages=4, strict=False)


@query(
    "link_targets",
    """SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 7 <> 0 THEN 'https://h/y?p=' || o_orderkey END AS link,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'https://h/api/more?p=' || o_orderkey END AS following FROM orders""",
)
def link_targets(spark, sf_dir):
    target = paging.header(F.col("headers"), "x-next")
    return _pages(spark, sf_dir).select(
        "page_id",
        paging.link_next(F.col("headers")).alias("link"),
        paging.join_url(F.col("url"), F.when(target != "", target)).alias("following"),
    )


@query(
    "failed_pages",
    """WITH bad AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 13 = 0)
       SELECT o_custkey AS seq_key, o_orderkey AS page_id,
         CASE WHEN o_orderkey % 13 = 0 THEN 'why-' || o_orderkey END AS error
       FROM orders WHERE o_orderkey % 13 = 0 OR o_custkey NOT IN (SELECT * FROM bad)""",
)
def failed_pages(spark, sf_dir):
    failed = F.try_variant_get(F.try_parse_json("body"), "$.failed", "boolean")
    sound, bad = paging.fail_pages(_pages(spark, sf_dir), SEQ, failed, "/reason")
    return sound.select("seq_key", "page_id", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("seq_key", "page_id", "error")
    )


@query(
    "page_rows",
    """WITH p AS (SELECT o_custkey AS seq_key, o_orderkey AS page_id,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS page_no FROM orders),
       e AS (SELECT seq_key, min(page_no) FILTER (WHERE page_id % 7 = 0) AS stop FROM p GROUP BY seq_key),
       kept AS (SELECT seq_key, page_id, CASE WHEN page_id % 9 = 0 THEN page_id % 3 ELSE 3 END AS n
                FROM p JOIN e USING (seq_key) WHERE page_no <= coalesce(stop, 1000000))
       SELECT seq_key, page_id, CAST(unnest(generate_series(1, n)) AS BIGINT) AS id FROM kept WHERE n > 0""",
)
def page_rows(spark, sf_dir):
    from feedloom.operators.decode import rows_at

    pages = paging.assemble_pages(_pages(spark, sf_dir), SEQ, paging.Pager("link_header"), 1000)
    rows = rows_at(pages, "body", "/rows", strict=True)
    return rows.select(
        "seq_key",
        "page_id",
        F.try_variant_get(at_pointer(F.try_parse_json("payload"), ""), "$.id", "bigint").alias("id"),
    )


# --- captures out of order ---------------------------------------------------------------------

# Orders of a customer in an order unlike that of their keys; of every seventh customers one closes a circle (1),
# one misses its third page (2), one has its second page twice (3) and one repeats the token it was asked with (4).
_SHUFFLED = """shuffled AS (
  SELECT o_custkey AS seq_key, o_orderkey AS page_id, row_number() OVER w - 1 AS n, count(*) OVER (PARTITION BY o_custkey) AS pages,
    'c' || lag(o_orderkey) OVER w AS asked, 'c' || first_value(o_orderkey) OVER w AS first_token
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey * 7919 % 10007, o_orderkey)),
  linked AS (
  SELECT seq_key, page_id, asked,
    CASE WHEN n + 1 < pages THEN 'c' || page_id WHEN seq_key % 7 = 1 THEN first_token WHEN seq_key % 7 = 4 THEN asked ELSE '' END AS next
  FROM shuffled WHERE seq_key % 7 <> 2 OR n <> 2),
  captured AS (
  SELECT * FROM linked UNION ALL
  SELECT seq_key, page_id + 10000000, asked, next FROM linked WHERE seq_key % 7 = 3 AND asked IN
    (SELECT first_token FROM shuffled s WHERE s.seq_key = linked.seq_key))"""

_WALKED = f"""WITH RECURSIVE {_SHUFFLED},
  nodes AS (SELECT seq_key, asked, min(page_id) AS page_id, nullif(arg_min(next, page_id), '') AS next FROM captured GROUP BY seq_key, asked),
  walk AS (
  SELECT seq_key, page_id, next, 0 AS page_no, [page_id] AS seen FROM nodes WHERE asked IS NULL
  UNION ALL
  SELECT n.seq_key, n.page_id, n.next, page_no + 1, list_append(seen, n.page_id)
  FROM walk w JOIN nodes n ON w.seq_key = n.seq_key AND w.next = n.asked WHERE NOT list_contains(seen, n.page_id)),
  ends AS (
  SELECT l.seq_key, l.page_no, l.page_id, l.next,
    CASE WHEN l.next IS NULL THEN 'complete' WHEN EXISTS (SELECT 1 FROM nodes n WHERE n.seq_key = l.seq_key AND n.asked = l.next)
         THEN 'loop' ELSE 'open' END AS status
  FROM (SELECT seq_key, max(page_no) AS page_no, arg_max(page_id, page_no) AS page_id, arg_max(coalesce(next, ''), page_no) AS last_next,
               nullif(arg_max(coalesce(next, ''), page_no), '') AS next FROM walk GROUP BY seq_key) l)"""


def _captured(spark, sf_dir):
    customer = Window.partitionBy("o_custkey")
    order = customer.orderBy(F.col("o_orderkey") * 7919 % 10007, "o_orderkey")
    token = F.concat(F.lit("c"), "o_orderkey")
    seventh = F.col("seq_key") % 7
    shuffled = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("seq_key"),
        F.col("o_orderkey").alias("page_id"),
        (F.row_number().over(order) - 1).alias("n"),
        F.count(F.lit(1)).over(customer).alias("pages"),
        F.lag(token).over(order).alias("asked"),
        F.first(token).over(order).alias("first_token"),
    )
    last = F.when(seventh == 1, F.col("first_token")).when(seventh == 4, F.col("asked")).otherwise(F.lit(""))
    following = F.when(F.col("n") + 1 < F.col("pages"), F.concat(F.lit("c"), "page_id")).otherwise(last)
    linked = shuffled.where((seventh != 2) | (F.col("n") != 2)).withColumn("next", following)
    times = F.when((seventh == 3) & (F.col("n") == 1), F.array(F.lit(0), F.lit(10_000_000))).otherwise(F.array(F.lit(0)))
    return linked.withColumn("more", F.explode(times)).select(
        "seq_key",
        (F.col("page_id") + F.col("more")).alias("page_id"),
        "asked",
        F.to_json(F.struct("next")).alias("body"),
    )


def _followed(spark, sf_dir, max_pages=1000):
    pager = paging.Pager("cursor", at="/next")
    return paging.follow_links(_captured(spark, sf_dir), SEQ, pager, max_pages, asked=F.col("asked"))


@query(
    "pages_by_links",
    f"""{_WALKED} SELECT w.seq_key, w.page_id, CAST(w.page_no AS BIGINT) AS page_no, e.status
       FROM walk w JOIN ends e USING (seq_key)""",
)
def pages_by_links(spark, sf_dir):
    kept, _ = _followed(spark, sf_dir)
    return kept.select("seq_key", "page_id", "page_no", "status")


@query(
    "page_link_problems",
    f"""{_WALKED}
       SELECT seq_key, CASE status WHEN 'open' THEN 'missing' ELSE 'loop' END AS kind, page_id, next AS link FROM ends WHERE status <> 'complete'
       UNION ALL
       SELECT n.seq_key, 'stray', n.page_id, n.asked FROM nodes n
       WHERE NOT EXISTS (SELECT 1 FROM walk w WHERE w.seq_key = n.seq_key AND w.page_id = n.page_id)
       UNION ALL
       SELECT c.seq_key, 'fork', c.page_id, c.asked FROM captured c JOIN nodes n
         ON c.seq_key = n.seq_key AND c.asked IS NOT DISTINCT FROM n.asked WHERE c.page_id <> n.page_id""",
)
def page_link_problems(spark, sf_dir):
    """Forks, stray pages, missing links and loops of shuffled captures, by name."""
    return _followed(spark, sf_dir)[1].select("seq_key", "kind", "page_id", "link")


@query(
    "offsets_by_number",
    """WITH p AS (SELECT o_custkey AS seq_key, o_orderkey AS page_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey * 7919 % 10007, o_orderkey) - 1 AS n,
         o_custkey % 4 + 1 AS total FROM orders)
       SELECT seq_key, page_id, CAST(n AS BIGINT) AS page_no,
         CASE WHEN max(n) OVER (PARTITION BY seq_key) >= total - 1 THEN 'complete' ELSE 'open' END AS status
       FROM p QUALIFY n < total""",
)
def offsets_by_number(spark, sf_dir):
    """Pages of three rows, captured out of order, put in order by the offset they were asked with."""
    order = Window.partitionBy("o_custkey").orderBy(F.col("o_orderkey") * 7919 % 10007, "o_orderkey")
    body = F.to_json(F.struct(F.array(*[F.lit(i) for i in range(3)]).alias("rows"), ((F.col("o_custkey") % 4 + 1) * 3).alias("total")))
    pages = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("seq_key"),
        F.col("o_orderkey").alias("page_id"),
        ((F.row_number().over(order) - 1) * 3).alias("offset"),
        body.alias("body"),
    )
    pager = paging.Pager("offset", rows_at="/rows", total_at="/total")
    kept, _ = paging.follow_links(pages, SEQ, pager, 1000, asked=F.col("offset"))
    return kept.select("seq_key", "page_id", "page_no", "status")


@query(
    "pages_null_keys",
    """WITH p AS (SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS seq_key, o_orderkey AS page_id, o_orderkey % 7 = 0 AS ends FROM orders),
       q AS (SELECT *, row_number() OVER (PARTITION BY seq_key ORDER BY page_id) - 1 AS page_no FROM p),
       e AS (SELECT seq_key, min(page_no) FILTER (WHERE ends) AS stop FROM q GROUP BY seq_key)
       SELECT q.seq_key, page_id, CAST(page_no AS BIGINT) AS page_no, CASE WHEN stop IS NULL THEN 'open' ELSE 'complete' END AS status
       FROM q JOIN e ON q.seq_key IS NOT DISTINCT FROM e.seq_key WHERE page_no <= coalesce(stop, page_no)""",
)
def pages_null_keys(spark, sf_dir):
    """A NULL sequence is a sequence like any other."""
    pages = _pages(spark, sf_dir)
    pages = pages.withColumn("seq_key", F.when(F.col("seq_key") % 3 > 0, F.col("seq_key")))
    out = paging.assemble_pages(pages, SEQ, paging.Pager("link_header"), 1 << 30)
    return out.select("seq_key", "page_id", F.col("page_no").cast("bigint").alias("page_no"), "status")


@query(
    "failed_pages_null",
    """WITH p AS (SELECT CASE WHEN o_custkey % 5 > 0 THEN o_custkey END AS seq_key, o_orderkey AS page_id FROM orders),
       bad AS (SELECT DISTINCT seq_key FROM p WHERE page_id % 13 = 0)
       SELECT seq_key, page_id, page_id % 13 = 0 AS failed FROM p
       WHERE page_id % 13 = 0 OR NOT EXISTS (SELECT 1 FROM bad WHERE bad.seq_key IS NOT DISTINCT FROM p.seq_key)""",
)
def failed_pages_null(spark, sf_dir):
    """A NULL sequence fails as a whole, too."""
    pages = _pages(spark, sf_dir).withColumn("seq_key", F.when(F.col("seq_key") % 5 > 0, F.col("seq_key")))
    failed = F.try_variant_get(F.try_parse_json("body"), "$.failed", "boolean")
    sound, bad = paging.fail_pages(pages, SEQ, failed, "/reason")
    return sound.select("seq_key", "page_id", F.lit(False).alias("failed")).unionByName(
        bad.select("seq_key", "page_id", F.lit(True).alias("failed"))
    )


@query(
    "url_pages_dots",
    """SELECT o_orderkey AS page_id, CASE o_orderkey % 8
         WHEN 0 THEN 'https://h/a/d' || o_orderkey WHEN 1 THEN 'https://h/d' || o_orderkey WHEN 2 THEN 'https://h/a/b/' || o_orderkey
         WHEN 3 THEN 'https://h/a/b/' WHEN 4 THEN 'https://h/a/' WHEN 5 THEN 'https://h/x/' || o_orderkey || '?q=/../y'
         WHEN 6 THEN 'https://h/a/b/c?p=' || o_orderkey ELSE 'https://o/' || o_orderkey || '#/./z' END AS following FROM orders""",
)
def url_pages_dots(spark, sf_dir):
    """Relative links with dot segments, resolved as URLs."""
    key = F.col("o_orderkey")
    links = ("../d{}", "../../../d{}", "./{}", ".", "%2E./", "/x/y/../{}?q=/../y", "?p={}", "https://o/a/.%2e/{}#/./z")
    target = F.element_at(F.array(*[F.format_string(t.replace("%2", "%%2").replace("{}", "%s"), key) for t in links]), (key % 8 + 1).cast("int"))
    base = F.lit("https://h/a/b/c?old=/../1#x")
    return table(spark, sf_dir, "orders").select(key.alias("page_id"), paging.join_url(base, target).alias("following"))
