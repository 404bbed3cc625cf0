"""Captured response pages: put sequences together, cut them by their pager and ceiling.

A sequence is one chain of requests (`seq_key`); `page_id` is a whole number that grows in
the order the pages were captured. Where it does not, `follow_links` finds the order. Pagers only decide, page by page, whether the sequence
ends there, so page bodies are never gathered per sequence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.json import (
    array_items,
    at_pointer,
    bind,
    let,
    pointer_text,
    scalar_text,
)
from feedloom.functions.keys import join_same
from feedloom.functions.numbering import number_rows, previous, running_sum, span_bucket
from feedloom.session import bounded_batches, cut_lineage

PAGE_SPAN = 10_000
# Pages up to which a sequence's links are followed inside of one task, and about as many are held there at once.
LOCAL_PAGES = 50_000
# Sequences up to which their ends are broadcast, a row each.
FEW_SEQUENCES = 10_000


def _merged(rows: DataFrame) -> DataFrame:
    """Rows as many as pages, for a join that must not broadcast them.

    The size of what is read from a checkpoint is guessed from the files behind it, far below that of its rows.
    """
    return rows.hint("merge")


def header(headers: Column, name: str) -> Column:
    """Value of a response header, whatever the case of its name."""
    named = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == F.lit(name.lower()))
    return F.get(named, F.lit(0))["value"]


def link_next(headers: Column) -> Column:
    """Target of the first `rel=next` link over all Link headers; NULL when there is none."""
    links = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == "link")
    text = F.array_join(F.transform(links, lambda e: e["value"]), ", ")
    found = F.regexp_extract(
        text, r'<([^>]*)>(?:\s*;\s*(?!rel\s*=)[^;,<]*)*\s*;\s*rel\s*=\s*(?:"next"|next(?![^\s;,]))', 1
    )
    return F.when(found != "", found)


def token_text(value: Column) -> Column:
    """Cursor token of a variant: a scalar as text, a list of scalars joined by commas.

    NULL (the sequence ends) when absent, empty, null, an object, or a list that holds
    anything but scalars.
    """

    def text(v: Column) -> Column:
        items = F.transform(array_items(v), scalar_text)
        whole = (F.size(items) > 0) & F.forall(items, lambda x: x.isNotNull())
        return F.when(items.isNull(), scalar_text(v)).when(whole, F.array_join(items, ","))

    return F.nullif(let(value, text), F.lit(""))


_DOT = r"(?:\.|%2[eE])"


def _without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments, as the URL standard removes them."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)

    def walk(done: Column, part: Column) -> Column:
        return (
            F.when(part.rlike(f"^{_DOT}$"), done)
            .when(part.rlike(f"^{_DOT}{_DOT}$"), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
            .otherwise(F.concat(done, F.array(part)))
        )

    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.slice(segments, 1, 1), walk)
    ended = F.when(last.rlike(f"^{_DOT}{{1,2}}$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(f"/{_DOT}{{1,2}}(?:/|$)"), F.array_join(ended, "/")).otherwise(path)


def join_url(base: Column, target: Column) -> Column:
    """Resolve a link against the URL it was found on; dot segments are removed."""
    whole = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
    origin = F.regexp_extract(base, f"({whole})", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    path = F.regexp_extract(base, f"{whole}([^?#]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(base, f"{whole}[^?#]*([?][^#]*)", 1)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    joined = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .when((target == "") | target.startswith("#"), F.concat(origin, path, query, target))
        .otherwise(F.concat(origin, folder, target))
    )
    return let(
        joined,
        lambda url: F.concat(
            F.regexp_extract(url, f"({whole})", 1),
            _without_dots(F.regexp_extract(url, f"{whole}([^?#]*)", 1)),
            F.regexp_extract(url, f"{whole}[^?#]*([?#].*)$", 1),
        ),
    )


def join_base(base: Column, target: Column) -> Column:
    """A link under a configured base: one slash between them, whole URLs as they are."""
    whole = target.rlike("^https?://")
    under = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(target, F.lit("/")))
    return F.when(whole, target).otherwise(under)


@dataclass(frozen=True)
class Pager:
    """How a sequence goes on.

    kind: none, link_header, cursor, page_number, offset or request_path.
    """

    kind: str
    at: str | None = None  # pointer of the token, next URL
    header: str | None = None  # or the header it is in
    total_at: str | None = None  # pointer of the total
    start: int = 0  # first page number or offset
    page_size: int | None = None
    rows_at: str | None = None  # pointer of the rows of a page
    base_url: str | None = None
    stop_when: Column | None = None


def _row_count(body: Column, pointer: str | None) -> Column:
    return let(
        at_pointer(F.try_parse_json(body), pointer or ""),
        lambda v: F.coalesce(F.array_size(array_items(v)), F.lit(0)),
    )


def _total(body: Column, pointer: str) -> Column:
    return pointer_text(body, pointer).try_cast("bigint")


def _next_text(pager: Pager) -> Column:
    if pager.header is not None:
        return F.nullif(header(F.col("headers"), pager.header), F.lit(""))
    return token_text(at_pointer(F.try_parse_json("body"), pager.at or ""))


def _signals(pages: DataFrame, seq: Sequence[str], pager: Pager) -> DataFrame:
    """What the pager needs to know of each page, without its body.

    `_next` is a token or URL, `_rows` and `_total` are counts, `_stop` ends the sequence.
    """
    body = F.col("body")
    token = F.lit(None).cast("string")
    rows = total = F.lit(None).cast("bigint")
    if pager.kind == "link_header":
        token = link_next(F.col("headers"))
    elif pager.kind in ("cursor", "request_path"):
        token = _next_text(pager)
        if pager.kind == "request_path":
            if pager.base_url is not None:
                token = join_base(F.lit(pager.base_url), token)
            else:
                token = join_url(F.col("url"), token)
    elif pager.kind in ("page_number", "offset"):
        if pager.rows_at is not None:
            rows = _row_count(body, pager.rows_at).cast("bigint")
        if pager.total_at is not None:
            total = _total(body, pager.total_at)
    elif pager.kind != "none":
        raise ValueError(f"unknown pager {pager.kind!r}")
    stop = F.lit(False)
    if pager.stop_when is not None:
        stop = F.coalesce(pager.stop_when, F.lit(False))
    return bind(pages, _next=token, _rows=rows, _total=total, _stop=stop).select(
        *seq, "page_id", "_next", "_rows", "_total", "_stop"
    )


def _judge(signals: DataFrame, seq: Sequence[str], pager: Pager) -> DataFrame:
    """Add `page_no`, `_ends` and `_loop` to the signals of each page.

    Only sequences of more than `PAGE_SPAN` pages are cut into buckets. Where the pages of many short ones lie far
    apart, nearly every page would be a bucket of its own, and the totals of buckets as many as the pages.
    """
    long = signals.groupBy(*seq).agg(F.count(F.lit(1)).alias("_pages")).where(F.col("_pages") > PAGE_SPAN)
    long = cut_lineage(long.select(*seq))
    if long.isEmpty():
        return _judged(signals, seq, pager, None)
    short = _judged(join_same(signals, long, seq, "left_anti"), seq, pager, None)
    in_seq = span_bucket("page_id", PAGE_SPAN)
    return short.unionByName(_judged(join_same(signals, long, seq, "left_semi"), seq, pager, in_seq))


def _judged(signals: DataFrame, seq: Sequence[str], pager: Pager, in_seq: Column | None) -> DataFrame:
    """`_judge` of sequences in buckets, or of short ones by a window over each."""
    out, along = signals, Window.partitionBy(*seq).orderBy("page_id")
    if pager.kind in ("cursor", "request_path"):
        # a page asked with a token that points to itself again; older tokens may come back
        if in_seq is None:
            out = out.withColumn("_asked", F.lag("_next").over(along))
        else:
            out = previous(out, "_next", "page_id", seq, in_seq, "_asked")
        out = out.withColumn("_loop", F.coalesce(F.col("_next") == F.col("_asked"), F.lit(False)))
        out = out.drop("_asked")
    else:
        out = out.withColumn("_loop", F.lit(False))
    if in_seq is None:
        out = out.withColumn("page_no", (F.row_number().over(along) - 1).cast("bigint"))
    else:
        out = number_rows(out, ["page_id"], seq, in_seq, out="page_no")
    if pager.kind == "none":
        done = F.lit(True)
    elif pager.kind in ("link_header", "cursor", "request_path"):
        done = F.col("_next").isNull()
    elif pager.kind == "page_number":
        if pager.total_at is not None:
            following = F.col("page_no") + F.lit(pager.start + 1)
            done = F.coalesce(following >= F.lit(pager.start) + F.col("_total"), F.lit(True))
        else:
            done = F.coalesce(F.col("_rows"), F.lit(0)) == 0
    else:
        step = F.col("_rows") if pager.rows_at is not None else F.lit(pager.page_size)
        out = out.withColumn("_step", step.cast("bigint"))
        if in_seq is None:
            before = F.sum("_step").over(along.rowsBetween(Window.unboundedPreceding, -1))
            out = out.withColumn("_before", F.coalesce(before, F.lit(0)))
        else:
            out = running_sum(out, "_step", ["page_id"], seq, in_seq, "_before")
        tests = []
        if pager.rows_at is not None:
            tests.append(F.col("_rows") == 0)
            if pager.page_size is not None:
                tests.append(F.col("_rows") < pager.page_size)
        if pager.total_at is not None:
            after = F.col("_before") + F.col("_step") + F.lit(pager.start)
            tests.append(
                F.coalesce(after >= F.lit(pager.start) + F.col("_total"), F.lit(True))
            )
        done = reduce(lambda a, b: a | b, tests, F.lit(False))
    out = out.withColumn("_ends", done | F.col("_stop"))
    # a page that ends the sequence is no loop, whatever token it carries
    return out.withColumn("_loop", F.col("_loop") & ~F.col("_ends"))


def assemble_pages(
    pages: DataFrame,
    seq: Sequence[str],
    pager: Pager,
    max_pages: int,
    strict: bool = True,
) -> DataFrame:
    """Pages that belong to each sequence, with `page_no` and the sequence's `status`.

    complete: the pager ended it. loop: a page repeats the token it was asked with (an error).
    ceiling: a
    windowed or dump unit went past `max_pages` and fails (`strict`). cut: a stateless unit
    is cut there. open: the capture stops before the sequence does.

    Everything is decided on the signals; the bodies are moved once, by the join at the
    end, whose key is unique per page.
    """
    # The signals are a few bytes a page and are read by every branch below; the bodies are parsed
    # for them once.
    judged = _judge(cut_lineage(_signals(pages, seq, pager)), seq, pager)
    stop = F.col("_ends") | F.col("_loop")
    ends = judged.groupBy(*seq).agg(
        F.min(F.when(stop, F.struct("page_no", "_loop"))).alias("_first"),
        F.max("page_no").alias("_last"),
    )
    over = F.coalesce(F.col("_first.page_no"), F.col("_last")) >= max_pages
    status = (
        F.when(over, F.lit("ceiling" if strict else "cut"))
        .when(F.col("_first").isNull(), F.lit("open"))
        .when(F.col("_first._loop"), F.lit("loop"))
        .otherwise(F.lit("complete"))
    )
    bounds = ends.select(
        *seq,
        status.alias("status"),
        F.least(
            F.coalesce(F.col("_first.page_no"), F.col("_last")), F.lit(max_pages - 1)
        ).alias("_until"),
    )
    kept = (
        join_same(judged, bounds, seq)
        .filter(F.col("page_no") <= F.col("_until"))
        .select(*seq, "page_id", "page_no", "status")
    )
    return join_same(pages, _merged(kept), [*seq, "page_id"])


def _links(pages: DataFrame, seq: Sequence[str], pager: Pager, asked: Column | None) -> DataFrame:
    """(_seq, page_id, _first, _asked, _to): the link each page was asked with and the one it gives, NULL at an end.

    Page numbers and offsets are links as well: a page gives the number that follows its own.
    """
    if asked is None:
        if pager.kind not in ("link_header", "request_path"):
            raise ValueError("this pager needs the column that a page was asked with")
        asked = F.col("url")
    signals = _signals(pages.withColumn("_asked", asked.cast("string")), [*seq, "_asked"], pager)
    link, following, done = F.col("_asked"), F.col("_next"), F.col("_next").isNull()
    first = link.isNull()
    if pager.kind in ("page_number", "offset"):
        number = F.coalesce(link.try_cast("bigint"), F.lit(pager.start).cast("bigint"))
        first = number == pager.start
        step = F.lit(1) if pager.kind == "page_number" else F.lit(pager.page_size)
        if pager.kind == "offset" and pager.rows_at is not None:
            step = F.col("_rows")
        after = number + step.cast("bigint")
        reached = F.coalesce(after >= F.lit(pager.start) + F.col("_total"), F.lit(True))
        tests = [reached] if pager.total_at is not None else []
        if pager.kind == "page_number" and not tests or pager.kind == "offset" and pager.rows_at is not None:
            tests.append(F.coalesce(F.col("_rows"), F.lit(0)) == 0)
        if pager.kind == "offset" and pager.rows_at is not None and pager.page_size is not None:
            tests.append(F.col("_rows") < pager.page_size)
        link, following = number.cast("string"), after.cast("string")
        done = reduce(lambda a, b: a | b, tests, F.lit(False))
    elif pager.kind == "none":
        done = F.lit(True)
    return signals.select(
        F.struct(*[F.col(f"`{c}`") for c in seq]).alias("_seq"),
        "page_id",
        first.alias("_first"),
        link.alias("_asked"),
        F.when(~(done | F.col("_stop")), following).alias("_to"),
    )


def _reached(heads: DataFrame, edges: DataFrame) -> DataFrame:
    """(_seq, page_id, page_no) of all pages on the way from each sequence's head.

    Pointers double: after k rounds a page points 2**k pages on, and the pages fewer than 2**k after the
    head are numbered; each round numbers the pages that the numbered ones point to. So rounds grow with
    the logarithm of the longest sequence. A page that is met again keeps its first number, and the rounds
    end when one numbers nothing new, which a cycle cannot prevent.
    """
    marks = heads.select("_seq", "page_id", F.lit(0).cast("bigint").alias("page_no"))
    jump, reach, before = edges.select("_seq", "page_id", F.col("_on").alias("_goal")), 1, -1
    marks = cut_lineage(marks)
    known = marks.count()
    while known > before:
        further = marks.join(_merged(jump), ["_seq", "page_id"]).select(
            "_seq", F.col("_goal").alias("page_id"), (F.col("page_no") + reach).alias("page_no")
        )
        marks = cut_lineage(marks.union(further).groupBy("_seq", "page_id").agg(F.min("page_no").alias("page_no")))
        on = jump.select("_seq", F.col("page_id").alias("_goal"), F.col("_goal").alias("_further"))
        jump = cut_lineage(
            jump.join(_merged(on), ["_seq", "_goal"]).select("_seq", "page_id", F.col("_further").alias("_goal"))
        )
        before, known, reach = known, marks.count(), 2 * reach
    return marks


# What is told of each link; `_last` and `_how` are those of its sequence.
_WALKED = ("_seq", "page_id", "_asked", "_to", "_node", "page_no", "_last", "_how")


def _solved_block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Links of whole sequences with the page that has a link first, its number, and where and how its sequence ends."""
    table = pa.Table.from_batches(batches).combine_chunks()
    n = table.num_rows
    pages = np.asarray(table["page_id"].combine_chunks())
    seq = np.cumsum(np.asarray(table["_n"]) == 1) - 1
    both = pa.concat_arrays([table[c].combine_chunks() for c in ("_asked", "_to")]).dictionary_encode()
    codes = np.asarray(both.indices.fill_null(-1)).astype(np.int64) + 1
    links, goals = (seq * (len(both.dictionary) + 1) + half for half in (codes[:n], codes[n:]))
    begins = np.append(True, links[1:] != links[:-1])
    nodes = np.flatnonzero(begins)
    on = np.full(n, -1)
    leading = nodes[codes[n:][nodes] > 0]
    order = nodes[np.argsort(links[nodes])]
    at = np.minimum(np.searchsorted(links[order], goals[leading]), len(order) - 1)
    hit = links[order][at] == goals[leading]
    on[leading[hit]] = order[at[hit]]
    named = np.zeros(n, bool)
    named[on[nodes][(on[nodes] >= 0) & (on[nodes] != nodes)]] = True
    first = np.asarray(table["_first"].combine_chunks().cast(pa.int8())) == 1
    ranked = nodes[np.lexsort((pages[nodes], named[nodes], ~first[nodes], seq[nodes]))]
    here = ranked[np.append(True, np.diff(seq[ranked]) != 0)]
    number, passed, last = np.full(n, -1), 0, here.copy()
    while len(here):  # a step of all sequences at once; a page that is met again has its number
        here = here[number[here] < 0]
        number[here] = passed
        last[seq[here]] = here
        here, passed = on[here], passed + 1
        here = here[here >= 0]
    own = nodes[np.cumsum(begins) - 1]
    kind = table.schema.field("page_id").type
    how = np.where(codes[n:][last] == 0, "complete", np.where(on[last] < 0, "open", "loop"))
    out = table.drop_columns(["_n", "_first"])
    out = out.append_column("_node", pa.array(pages[own], kind))
    out = out.append_column("page_no", pa.array(number, pa.int64(), mask=number < 0))
    out = out.append_column("_last", pa.array(number[last][seq], pa.int64()))
    return out.append_column("_how", pa.array(how[seq], pa.string())).combine_chunks().to_batches()[0]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole sequences; `_n` counts the links of each from 1."""
    held, rows = [], 0
    for batch in batches:
        starts = np.flatnonzero(np.asarray(batch.column("_n")) == 1)
        if rows + batch.num_rows >= LOCAL_PAGES and len(starts):
            at = int(starts[-1])
            if rows + at:
                yield _solved_block([*held, batch.slice(0, at)])
            held, rows = [], 0
            batch = batch.slice(at)
        held.append(batch)
        rows += batch.num_rows
    if rows:
        yield _solved_block(held)


def _walked_inside(links: DataFrame) -> DataFrame:
    """`_WALKED` of sequences that a task can hold: one shuffle, no rounds."""
    bounded_batches(links.sparkSession)
    number = F.row_number().over(Window.partitionBy("_seq").orderBy("_asked", "page_id"))
    kind = links.schema["page_id"].dataType
    told = [T.StructField("_node", kind), *(T.StructField(c, T.LongType()) for c in ("page_no", "_last")), T.StructField("_how", T.StringType())]
    schema = T.StructType([links.schema[c] for c in _WALKED[:4]] + told)
    return cut_lineage(links.withColumn("_n", number).mapInArrow(_solved, schema))


def _walked_in_rounds(links: DataFrame) -> DataFrame:
    """The same of sequences of any length, by rounds over all of their pages."""
    key = F.struct("_seq", "_asked")
    one = links.groupBy(key.alias("_link")).agg(F.min(F.struct("page_id", "_first", "_to")).alias("_page"))
    nodes = cut_lineage(one.select("_link._seq", "_link._asked", "_page.*"))
    goals = nodes.select(F.struct("_seq", F.col("_asked").alias("_to")).alias("_link"), F.col("page_id").alias("_on"))
    edges = nodes.where(F.col("_to").isNotNull()).select("_seq", "page_id", F.struct("_seq", "_to").alias("_link"))
    edges = cut_lineage(edges.join(_merged(goals), "_link").select("_seq", "page_id", "_on"))

    named = edges.where("page_id <> _on").select("_seq", F.col("_on").alias("page_id")).distinct()
    starts = nodes.join(_merged(named.withColumn("_named", F.lit(True))), ["_seq", "page_id"], "left")
    rank = F.struct(~F.col("_first"), F.coalesce("_named", F.lit(False)), "page_id")
    heads = starts.groupBy("_seq").agg(F.min(rank).alias("_head")).select("_seq", "_head.page_id")
    marks = _reached(heads, edges)
    last = marks.groupBy("_seq").agg(F.max(F.struct("page_no", "page_id")).alias("_end")).select("_seq", "_end.*")
    last = last.join(_merged(nodes.select("_seq", "page_id", "_to")), ["_seq", "page_id"]).join(_merged(edges), ["_seq", "page_id"], "left")
    how = F.when(F.col("_to").isNull(), F.lit("complete")).when(F.col("_on").isNull(), F.lit("open")).otherwise(F.lit("loop"))
    ends = last.select("_seq", F.col("page_no").alias("_last"), how.alias("_how"))
    # of few sequences each may be long, and then no task should hold one
    few = marks.where("page_no = 0").count() <= FEW_SEQUENCES
    ends = F.broadcast(ends) if few else _merged(ends)
    firsts = nodes.select(key.alias("_link"), F.col("page_id").alias("_node"))
    twins = links.withColumn("_link", key).join(_merged(firsts), "_link").drop("_link")
    told = twins.join(_merged(marks), ["_seq", "page_id"], "left").join(ends, "_seq")
    return cut_lineage(told.select(*_WALKED))


def _walked(links: DataFrame) -> DataFrame:
    """Links with `_node`, the page that has a link first, and its `page_no` if its sequence reaches it.

    `_last` is the number of the last page that the sequence reaches, and `_how` tells whether it is complete there,
    open or a loop.
    """
    if not isinstance(links.schema["page_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return _walked_in_rounds(links)
    long = links.groupBy("_seq").agg(F.count(F.lit(1)).alias("_pages")).where(F.col("_pages") > LOCAL_PAGES)
    long = cut_lineage(long.select("_seq"))
    if long.isEmpty():
        return _walked_inside(links)
    short = _walked_inside(links.join(long, "_seq", "left_anti"))
    return short.unionByName(_walked_in_rounds(links.join(long, "_seq", "left_semi")))


def follow_links(
    pages: DataFrame,
    seq: Sequence[str],
    pager: Pager,
    max_pages: int,
    strict: bool = True,
    asked: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(pages with `page_no` and `status`, problems): sequences put together by their links.

    For captures whose `page_id` does not follow the requests; it only has to be unique in its sequence.
    `asked` is the token, page number or offset that a page was asked with, NULL for a sequence's first
    request; where the pager gives URLs it is the page's own `url`. A sequence begins at the page asked
    with nothing, else at one that no page names, else at any; of several at the one with the smallest
    `page_id`. The statuses are those of `assemble_pages`; a sequence that comes back to one of its pages
    is a `loop` as well, and one whose next page was not captured is `open`.

    Problems are (`kind`, `page_id`, `link`): `fork`, a page asked with the same link as another one, which
    has the smaller `page_id` and goes on; `stray`, a page that the sequence does not reach; `missing` and
    `loop`, the last page and where it leads. Only the signals of pages are walked, as in `assemble_pages`:
    sequences of up to `LOCAL_PAGES` pages many at once in a task, longer ones by rounds over all tasks.
    """
    links = cut_lineage(_links(pages, seq, pager, asked))
    every = _walked(links)
    walked = every.where("page_id = _node")
    over = F.col("_last") >= max_pages
    status = F.when(over, F.lit("ceiling" if strict else "cut")).otherwise(F.col("_how"))
    on_way = walked.where(F.col("page_no") <= F.least(F.col("_last"), F.lit(max_pages - 1)))
    kept = on_way.select("_seq.*", "page_id", "page_no", status.alias("status"))

    ends = walked.where("page_no = _last AND _how <> 'complete'").select(
        "_seq",
        F.when(F.col("_how") == "open", F.lit("missing")).otherwise(F.lit("loop")).alias("kind"),
        "page_id",
        F.col("_to").alias("link"),
    )
    stray = walked.where(F.col("page_no").isNull()).select("_seq", F.lit("stray").alias("kind"), "page_id", F.col("_asked").alias("link"))
    forks = every.where("page_id <> _node").select("_seq", F.lit("fork").alias("kind"), "page_id", F.col("_asked").alias("link"))
    problems = ends.union(stray).union(forks).select("_seq.*", "kind", "page_id", "link")
    return join_same(pages, _merged(kept), [*seq, "page_id"]), problems


def sequence_status(assembled: DataFrame, seq: Sequence[str]) -> DataFrame:
    """One row per sequence: `status` and the pages it keeps."""
    return assembled.groupBy(*seq).agg(
        F.first("status").alias("status"), F.count(F.lit(1)).alias("pages")
    )


def fail_pages(
    pages: DataFrame, seq: Sequence[str], condition: Column, error_at: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(pages of sound sequences, failing pages with `error`): a unit fails as a whole.

    A condition that is neither true nor false is an error as well.
    """
    text = F.lit(None).cast("string")
    if error_at is not None:
        text = pointer_text(F.col("body"), error_at)
    judged = bind(pages, _fails=condition)
    failed = judged.filter(F.col("_fails").isNull() | F.col("_fails")).withColumn(
        "error",
        F.when(F.col("_fails").isNull(), F.lit("page condition is not a boolean")).otherwise(
            F.coalesce(text, F.lit("page condition failed"))
        ),
    )
    bad = failed.select(*seq).distinct()
    return join_same(pages, bad, seq, "left_anti"), failed.drop("_fails")
