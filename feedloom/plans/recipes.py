"""Feed recipes: what each provider's responses look like, as data over captured pages.

A recipe only names operators and the places they look at. `unit_steps` plans what a unit asks
for; `run_pages` puts its captured pages through the operators; `run_lookup`, `run_manifest`,
`run_objects` and `run_fold` cover the units that fetch in two steps, `run_keys` those that ask for
listed keys, `run_dump` those that read a whole store and `run_pull` queues.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import as_column, at_pointer, pointer_text, put_fields, scalar_text
from feedloom.operators import builders, decode, fanout, listing, paging, snapshot, windows
from feedloom.operators.paging import Pager


@dataclass(frozen=True)
class Recipe:
    """One unit of a provider."""

    decoder: str = "json_at"  # json_at, array, ndjson, json, lines, document, columnar, messages
    rows_at: str = ""
    when_absent: str = "fail"
    pager: Pager = field(default_factory=lambda: Pager("none"))
    quoted: bool = False
    builder: str | None = None  # audit_event, stamp_absent, event_time, wrap_non_object
    builder_args: Mapping[str, Any] = field(default_factory=dict)
    fail_unless: tuple[str, str] | None = None  # pointer and the only value a sound page has
    stop_at: tuple[str, str] | None = None  # pointer and the value that ends a sequence
    error_at: str | None = None
    id_at: str | None = None  # pointer of the id in a listed row that is looked up
    lookup_batch: int = 1000
    max_items: int | None = None
    contents: str | None = None  # decoder of a manifest's contents
    gzip: bool = False  # whether contents may be gzip, found by its magic
    key_field: str | None = None  # field that a keyed unit's records get their key in
    ignore_status: tuple[int, ...] = ()  # statuses of a keyed unit's answers that only mean that there is none
    windowed: bool = True  # reads a window; a unit that does not has current state only
    shape: str = "incremental"  # or dump
    row_key: str | None = None
    window_format: str = "rfc3339_secs"
    step_secs: int | None = None
    settle_secs: int = 0
    overlap_secs: int = 0
    max_pages: int = 1000

    @property
    def strict(self) -> bool:
        """Whether pages left unread would be lost: a window or a dump, not a current state."""
        return self.windowed or self.shape == "dump"


def _token(at: str, **more: Any) -> Pager:
    return Pager("cursor", at=at, **more)


def _url(at: str, **more: Any) -> Pager:
    return Pager("request_path", at=at, **more)


def _aws(rows_at: str, token: str, **more: Any) -> Recipe:
    return Recipe(**{"rows_at": rows_at, "pager": _token(token), "max_pages": 50, **more})


def _odata(rows_at: str = "/value", link: str = "/nextLink", **more: Any) -> Recipe:
    return Recipe(**{"rows_at": rows_at, "pager": _url(link), "max_pages": 10, **more})


def _entra(time: str) -> Recipe:
    return _odata(link="/@odata.nextLink", builder="event_time", builder_args={"field": time})


_CONTENT = Recipe(
    decoder="array",
    pager=Pager("request_path", header="NextPageUri"),
    contents="array",
    window_format="strftime:%Y-%m-%dT%H:%M:%S",
    step_secs=86_400,
    max_pages=50,
)
_OFFSET_TIME = "strftime:%Y-%m-%dT%H:%M:%S%.f+00:00"


def _listed(rows_at: str, **more: Any) -> Recipe:
    base = {"when_absent": "empty", "pager": _token("/nextPageToken"), "window_format": _OFFSET_TIME}
    return Recipe(rows_at=rows_at, **{**base, **more})


def _dump(row_key: str) -> Recipe:
    return Recipe(decoder="ndjson", shape="dump", windowed=False, row_key=row_key)


def _keyed(key_field: str) -> Recipe:
    return Recipe(decoder="document", windowed=False, key_field=key_field, ignore_status=(404,))


def _objects(contents: str, gzip: bool = False, wrap: bool = True) -> Recipe:
    return Recipe(
        contents=contents,
        gzip=gzip,
        builder="wrap_non_object" if wrap else None,
        max_items=1000,
        settle_secs=300,
    )


# The content feeds, log feeds, activity applications and inventory stores.
_CONTENT_FEEDS = (
    "audit_log.audit_azureactivedirectory",
    "audit_log.audit_exchange",
    "audit_log.audit_sharepoint",
    "audit_log.audit_general",
    "audit_log.dlp_all",
    "dlp",
    "exchange_audit",
)
_LOG_FEEDS = (
    "admin_activity",
    "data_access",
    "system_event",
    "policy_denied",
    "vpc_flow_logs",
    "dns_queries",
    "storage_access",
    "cloud_logging",
)
_APPLICATIONS = (
    "access_evaluation",
    "access_transparency",
    "admin",
    "admin_data_action",
    "assignments",
    "calendar",
    "chat",
    "chrome",
    "chrome_sync",
    "classroom",
    "cloud_search",
    "contacts",
    "context_aware_access",
    "data_migration",
    "data_studio",
    "directory_sync",
    "drive",
    "gcp",
    "gemini_in_workspace_apps",
    "gmail",
    "gplus",
    "graduation",
    "groups",
    "groups_enterprise",
    "jamboard",
    "keep",
    "ldap",
    "login",
    "meet",
    "meet_hardware",
    "mobile",
    "profile",
    "rules",
    "saml",
    "takeout",
    "tasks",
    "token",
    "user_accounts",
    "vault",
    "voice",
    "workspace_studio",
)
_INVENTORY = {
    "assets": "/id",
    "sites": "/id",
    "certificates": "/id",
    "services": "/service_id",
    "software": "/software_id",
    "vulnerabilities": "/vulnerability_id",
    "findings": "/finding_code",
    "tasks": "/id",
    "users": "/id",
    "groups": "/id",
    "wireless": "/id",
}

# Where each provider's public API puts rows, tokens and errors, and how far it reads.
RECIPES: dict[str, dict[str, Recipe]] = {
    "aws": {
        "cloudtrail": _aws("/Events", "/NextToken", builder="audit_event", max_pages=200),
        "guardduty": _aws("/findingIds", "/nextToken", id_at="", lookup_batch=50, windowed=False),
        "securityhub": _aws(
            "/Findings", "/NextToken", window_format="rfc3339_millis", max_pages=200
        ),
        "config": _aws("/Results", "/NextToken", quoted=True, windowed=False),
        "cloudwatch_logs": _aws(
            "/events", "/nextToken", builder="stamp_absent", window_format="epoch_millis"
        ),
        "cloudwatch_metrics": _aws("/Metrics", "/NextToken", lookup_batch=500, max_pages=10),
        "inspector": _aws("/findings", "/nextToken"),
        "health": _aws("/events", "/nextToken"),
    },
    "azure": {
        "activity_log": _odata(),
        "defender": _odata(windowed=False),
        "sentinel": _odata(windowed=False),
        "entra_signins": _entra("createdDateTime"),
        "entra_directory_audits": _entra("activityDateTime"),
        "entra_provisioning": _entra("activityDateTime"),
        "log_analytics": Recipe(decoder="columnar", rows_at="/tables", max_pages=10),
    },
    "m365": {
        **dict.fromkeys(_CONTENT_FEEDS, _CONTENT),
        "alerts": _odata(link="/@odata.nextLink", windowed=False),
    },
    "gcp": {
        **dict.fromkeys(_LOG_FEEDS, _listed("/entries", max_pages=10)),
        "scc": _listed("/listFindingsResults", windowed=False, max_pages=10),
    },
    "gcp_pubsub": {
        "pull": Recipe(
            decoder="messages", rows_at="/receivedMessages", when_absent="empty", windowed=False
        )
    },
    "google_workspace": dict.fromkeys(_APPLICATIONS, _listed("/items", max_pages=50)),
    "okta": {
        "system_log": Recipe(
            decoder="array", pager=Pager("link_header"), window_format="rfc3339_millis", max_pages=50
        )
    },
    "github": {
        "audit_log": Recipe(
            decoder="array",
            pager=Pager("link_header"),
            window_format="strftime:%Y-%m-%dT%H:%M:%S+00:00",
            max_pages=50,
        )
    },
    "bitwarden": {
        "events": Recipe(rows_at="/data", pager=_token("/continuationToken"), max_pages=50)
    },
    "datadog": {
        name: Recipe(
            rows_at="/data",
            pager=_token("/meta/page/after"),
            window_format="rfc3339_millis",
            max_pages=50,
        )
        for name in ("audit_events", "security_signals")
    },
    "duo": {
        "authentication_logs": Recipe(
            rows_at="/response/authlogs",
            pager=_token("/response/metadata/next_offset"),
            fail_unless=("/stat", "OK"),
            error_at="/message",
            window_format="epoch_millis",
            settle_secs=120,
            max_pages=50,
        )
    },
    "onepassword": {
        name: Recipe(
            rows_at="/items",
            pager=_token("/cursor"),
            stop_at=("/has_more", "false"),
            window_format="rfc3339_millis",
            max_pages=50,
        )
        for name in ("signin_attempts", "item_usages", "audit_events")
    },
    "slack": {
        "audit_logs": Recipe(
            rows_at="/entries",
            pager=_token("/response_metadata/next_cursor"),
            fail_unless=("/ok", "true"),
            error_at="/error",
            window_format="epoch_secs",
            max_pages=50,
        )
    },
    "cloudflare": {
        "audit_logs": Recipe(
            rows_at="/result",
            pager=Pager("page_number", total_at="/result_info/total_pages", start=1),
            fail_unless=("/success", "true"),
            error_at="/errors/0/message",
            max_pages=50,
        )
    },
    "crowdstrike": {
        "alerts": Recipe(
            rows_at="/resources",
            pager=Pager("offset", total_at="/meta/pagination/total", rows_at="/resources"),
            id_at="",
            lookup_batch=1000,
            max_pages=50,
        )
    },
    "s4hana": {
        "entity_set": Recipe(
            rows_at="/d/results",
            pager=_url("/d/__next"),
            window_format="strftime:%Y-%m-%dT%H:%M:%S",
            settle_secs=300,
            overlap_secs=300,
            max_pages=100,
        )
    },
    "salesforce": {
        "setup_audit_trail": _odata("/records", "/nextRecordsUrl", max_pages=50),
        "login_history": _odata("/records", "/nextRecordsUrl", max_pages=50),
        "event_log_file": _odata(
            "/records", "/nextRecordsUrl", contents="csv", max_items=200, max_pages=50
        ),
    },
    "runzero": {unit: _dump(key) for unit, key in _INVENTORY.items()},
    "object_store": {
        "json_gz": _objects("ndjson", gzip=True),
        "json": _objects("json"),
        "jsonl": _objects("ndjson"),
        "text": _objects("lines", wrap=False),
        "text_gz": _objects("lines", gzip=True, wrap=False),
    },
    "pypi": {"metadata": _keyed("_package")},
    "crates_io": {"metadata": _keyed("_crate")},
    "go_modules": {
        "metadata": Recipe(decoder="lines", contents="document", max_items=100, windowed=False)
    },
}


def _decode(pages: DataFrame, decoder: str, rows_at: str, when_absent: str) -> DataFrame:
    if decoder == "json_at":
        return decode.rows_at(pages, "body", rows_at, when_absent, strict=True)
    if decoder == "array":
        return decode.explode_array(pages, "body")
    if decoder == "ndjson":
        return decode.decode_ndjson(pages, "body")
    if decoder == "lines":
        return decode.decode_lines(pages, "body")
    if decoder == "json":
        return decode.decode_json(pages, "body")
    if decoder == "document":
        return decode.decode_document(pages, "body")
    if decoder == "csv":
        return decode.decode_csv(pages, "body")
    if decoder == "columnar":
        tables = decode.rows_at(pages, "body", rows_at, when_absent, strict=True)
        tables = tables.withColumnRenamed("payload", "_table").drop("pos")
        return builders.columnar_table(tables, "_table").drop("_table")
    if decoder == "messages":
        found = decode.rows_at(pages, "body", rows_at, when_absent, strict=True)
        return builders.decode_message(
            found.withColumnRenamed("payload", "_message_text"), "_message_text", F.col("unit")
        )
    raise ValueError(f"unknown decoder {decoder!r}")


def _build(rows: DataFrame, recipe: Recipe, stamps: Mapping[str, Any] | None) -> DataFrame:
    if recipe.quoted:
        rows = rows.withColumn("payload", decode.unquote(F.col("payload")))
    if recipe.builder == "audit_event":
        return builders.audit_event(rows)
    if recipe.builder == "stamp_absent":
        return builders.stamp_absent(rows, dict(stamps or {}))
    if recipe.builder == "event_time":
        return builders.event_time(rows, recipe.builder_args["field"])
    if recipe.builder == "wrap_non_object":
        return rows.withColumn("payload", builders.wrap_non_object(F.col("payload")))
    return rows


def unit_steps(
    units: DataFrame, cursors: DataFrame, recipe: Recipe, now: Any, key: str = "cursor_key"
) -> DataFrame:
    """Steps of each unit's next window with `start_text` and `end_text`, the bounds as asked for.

    The window is planned, moved back by the recipe's overlap, held back to what has settled, and
    cut in the recipe's steps. A unit that reads no window has one step without bounds.
    """
    planned = windows.plan_windows(units, cursors, now, key)
    settled = windows.settle(planned, now, recipe.settle_secs)
    moved = windows.overlap(settled, recipe.overlap_secs) if recipe.overlap_secs else settled
    width = F.unix_seconds("window_end") - F.unix_seconds("window_start") + 1
    step = F.lit(recipe.step_secs) if recipe.step_secs else F.greatest(width, F.lit(1))
    steps = windows.window_steps(moved, step, F.lit(recipe.windowed))
    return steps.withColumns(
        {
            "start_text": windows.format_bound(F.col("step_start"), recipe.window_format),
            "end_text": windows.format_bound(F.col("step_end"), recipe.window_format),
        }
    )


def run_pages(
    pages: DataFrame,
    recipe: Recipe,
    seq: Sequence[str] = ("seq_key",),
    stamps: Mapping[str, Any] | None = None,
    fields: Mapping[str, Any] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records, problems): every sequence is read or named among the problems.

    A problem has `status`, `page_id` and `error`: `failed` for a page that says so, `loop` and
    `ceiling` for sequences that fail as a whole (their window is read again, in halves), `cut` for
    a current state whose first pages were read.
    """
    problems = None
    if recipe.fail_unless is not None:
        pointer, value = recipe.fail_unless
        bad = ~F.coalesce(pointer_text(F.col("body"), pointer) == value, F.lit(False))
        pages, failed = paging.fail_pages(pages, seq, bad, recipe.error_at)
        problems = failed.select(*seq, F.lit("failed").alias("status"), "page_id", "error")
    pager = recipe.pager
    if recipe.stop_at is not None:
        pointer, value = recipe.stop_at
        pager = replace(pager, stop_when=pointer_text(F.col("body"), pointer) == value)
    kept = paging.assemble_pages(pages, list(seq), pager, recipe.max_pages, recipe.strict)
    last = kept.groupBy(*seq, "status").agg(F.max("page_id").alias("page_id"))
    short = last.filter(F.col("status").isin("loop", "ceiling", "cut")).select(
        *seq,
        "status",
        "page_id",
        F.when(F.col("status") == "loop", F.lit("a page repeats the token it was asked with"))
        .otherwise(F.lit(f"more than {recipe.max_pages} pages"))
        .alias("error"),
    )
    problems = short if problems is None else problems.unionByName(short)
    sound = kept.filter(F.col("status").isin("complete", "open", "cut"))
    rows = _build(_decode(sound, recipe.decoder, recipe.rows_at, recipe.when_absent), recipe, stamps)
    if fields:
        rows = put_fields(rows, "payload", fields)
    return rows, problems


def run_pull(
    pulls: DataFrame, recipe: Recipe, fields: Mapping[str, Any] | None = None
) -> DataFrame:
    """Messages of every captured pull of a queue; an empty pull gives no row.

    A queue has no page order: each response stands for itself, and acknowledging is what moves it.
    """
    rows = _build(_decode(pulls, recipe.decoder, recipe.rows_at, recipe.when_absent), recipe, None)
    return put_fields(rows, "payload", fields) if fields else rows


def run_dump(
    bodies: DataFrame,
    recipe: Recipe,
    store: str,
    at: Any,
    completed_at: Any,
    run: str,
    order: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Snapshot frames of a dump's rows, oversize stubs named by the recipe's row key."""
    if recipe.shape != "dump":
        raise ValueError("not a dump")
    rows = _decode(bodies, recipe.decoder, recipe.rows_at, recipe.when_absent)
    return snapshot.frame_snapshot(
        rows, store, at, completed_at, run, order, row_key=recipe.row_key, bucket=bucket
    )


def run_fold(
    listed: DataFrame, documents: DataFrame, recipe: Recipe, key: str, on: str, position: str
) -> tuple[DataFrame, DataFrame | None]:
    """(one folded record per key, report of documents over the cap or None).

    `listed` names the documents of each key in order, `documents` has their bodies by `key`, `on`.
    """
    report = None
    if recipe.max_items is not None:
        listed, report = fanout.cap_items(listed, [key], [position, on], recipe.max_items, "cut")
    read = _decode(documents, recipe.contents or recipe.decoder, recipe.rows_at, recipe.when_absent)
    joined = read.join(listed.select(key, on, position), [key, on])
    return builders.version_fold(joined, key, position, "payload", F.lit(0)), report


def run_keys(
    keys: DataFrame, answers: DataFrame, recipe: Recipe, on: str = "key", status: str = "status"
) -> tuple[DataFrame, DataFrame]:
    """(records with their key under the recipe's field, problems) of a unit that asks once for each key.

    `answers` has `on`, `status` and `body`. An ignored status gives no record; any other that is no success
    is a problem (`failed`), and so is a key without an answer (`missing`). A key that is listed twice is asked once.
    """
    asked = keys.select(on).where(F.col(on).isNotNull()).distinct()
    found = asked.join(answers.select(on, status, "body"), on, "left")
    good = F.col(status).between(200, 299)
    ignored = F.col(status).isin(*recipe.ignore_status) if recipe.ignore_status else F.lit(False)
    rows = _build(_decode(found.where(good), recipe.decoder, recipe.rows_at, recipe.when_absent), recipe, None)
    if recipe.key_field is not None:
        rows = put_fields(rows, "payload", {recipe.key_field: F.col(on).cast("string")})
    bad = found.where(F.col(status).isNull() | ~(good | ignored))
    why = F.when(F.col(status).isNull(), F.lit("missing")).otherwise(F.lit("failed"))
    return rows.select(on, "payload"), bad.select(on, why.alias("problem"), F.col(status).alias("status"))


def run_lookup(
    listed: DataFrame,
    recipe: Recipe,
    entities: DataFrame,
    on: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Entities of the ids a listing gave, batch by batch."""
    value = at_pointer(F.try_parse_json("payload"), recipe.id_at or "")
    ids = listed.withColumn(on, scalar_text(value)).filter(F.col(on).isNotNull())
    return fanout.lookup(ids, entities, on, order, recipe.lookup_batch, by, bucket)


def run_metrics(
    listed: DataFrame, recipe: Recipe, order: Sequence[str], bucket: Column | None = None
) -> DataFrame:
    """Listed descriptors as numbered queries: `batch_no`, `query_id`, `query` and their own parts.

    `builders.metric_points` and `builders.gauge_group` join the answers to them.
    """
    parsed = listed.withColumn(
        "_d",
        F.from_json(
            "payload",
            "Namespace string, MetricName string, Unit string, Dimensions array<struct<Name:string,Value:string>>",
        ),
    )
    named = F.transform(
        "_d.Dimensions", lambda d: F.struct(d["Name"].alias("name"), d["Value"].alias("value"))
    )
    descriptors = parsed.select(
        *order,
        F.col("_d.Namespace").alias("namespace"),
        F.col("_d.MetricName").alias("metric"),
        F.coalesce("_d.Unit", F.lit(builders.METRIC_UNIT)).alias("unit"),
        named.alias("dimensions"),
    )
    asked = builders.metric_queries(descriptors, order, recipe.lookup_batch, bucket)
    return asked.withColumn(
        "query",
        builders.query_object(
            *[F.col(c) for c in ("query_id", "namespace", "metric", "dimensions", "period", "stat")]
        ),
    )


def run_manifest(
    items: DataFrame,
    contents: DataFrame,
    recipe: Recipe,
    on: str,
    position: str,
    by: Sequence[str] = (),
    add: Mapping[str, Any] | None = None,
    mode: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(marked records of the listed items, report of items over the cap or None).

    `by` is the listing an item is from; without it all items are one listing. By default a windowed
    unit over the cap fails and a current state is cut; a marked listing says `defer`. Contents are
    text, or bytes where the recipe has gzip.
    """
    report = None
    if recipe.max_items is not None:
        listing = list(by) or ["_listing"]
        items = items if by else items.withColumn("_listing", F.lit(0))
        mode = mode or ("fail" if recipe.windowed else "cut")
        items, report = fanout.cap_items(items, listing, [position, on], recipe.max_items, mode)
        if not by:
            items, report = items.drop("_listing"), report.drop("_listing")
    if recipe.gzip:
        contents = decode.inflate(contents, "body")
        body = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("body"))
        contents = contents.withColumn("body", F.make_valid_utf8(body.cast("string"))).drop("error")
    rows = _decode(contents, recipe.contents or recipe.decoder, recipe.rows_at, recipe.when_absent)
    rows = _build(rows.drop("body"), recipe, None)
    return fanout.manifest(items, rows, on, add or {}, position), report


def run_objects(
    objects: DataFrame,
    contents: DataFrame,
    recipe: Recipe,
    marker: tuple[Any, str] | None,
    now: Any,
    provider: str,
    store: str,
    envelope_field: str = "_object",
) -> tuple[DataFrame, DataFrame | None]:
    """(records of the objects past the marker and settled, report of those left for later).

    `objects` is a listing (path, position, size), `contents` has `path` and `body`. Every record
    gets the object's envelope under `envelope_field`; more objects than the recipe's cap are
    deferred, as the marker stands at the last one read.
    """
    listed = listing.order_listing(objects, marker)
    horizon = F.timestamp_micros(
        F.unix_micros(as_column(now).cast("timestamp")) - F.lit(recipe.settle_secs * 1_000_000)
    )
    listed = listed.filter(F.col("position") < horizon)
    envelope = F.struct(
        F.lit(provider).alias("provider"),
        F.lit(store).alias("bucket"),
        F.col("path").alias("key"),
        windows.format_bound(F.col("position"), "rfc3339_millis").alias("last_modified"),
        F.col("size").cast("string").alias("size"),
    )
    return run_manifest(
        listed, contents, recipe, "path", "position", add={envelope_field: envelope}, mode="defer"
    )


__all__ = [
    "RECIPES",
    "Recipe",
    "run_dump",
    "run_fold",
    "run_keys",
    "run_lookup",
    "run_manifest",
    "run_metrics",
    "run_objects",
    "run_pages",
    "run_pull",
    "unit_steps",
]
