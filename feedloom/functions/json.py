"""JSON records as columns: strict parsing, pointers, type-checked access, key splicing.

A record stays text on the row. `document()` parses it once into `map<string,variant>`;
operators put that in a working column, so each record is parsed once per stage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns that are computed exactly once per row.

    A plain projection is copied into every filter and expression above it, which parses a
    record once per reference. A generator of one row is not: its output is a value, while
    filters on other columns still pass below it.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*rest, F.inline(F.array(row)))


def _guarded(payload: Column) -> Column:
    # Spark's parsers ignore whatever follows the first value. Closing the text inside an
    # array with a known last element turns trailing text into a parse failure.
    return F.concat(F.lit("["), payload, F.lit(",{}]"))


def is_json(payload: Column) -> Column:
    """True when the text is exactly one JSON value."""
    return let(
        F.from_json(_guarded(payload), "array<string>", _STRICT),
        lambda parts: F.coalesce(
            (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == "{}"), F.lit(False)
        ),
    )


def is_object(payload: Column) -> Column:
    """True when the text is exactly one JSON object."""
    return F.coalesce(F.ltrim(payload).startswith("{"), F.lit(False)) & is_json(payload)


def is_array(payload: Column) -> Column:
    """True when the text is exactly one JSON array."""
    return F.coalesce(F.ltrim(payload).startswith("["), F.lit(False)) & is_json(payload)


def json_value(text: Column) -> Column:
    """The text as a variant; NULL unless it is exactly one JSON value."""
    return let(
        F.from_json(_guarded(text), "array<variant>", _STRICT),
        lambda parts: F.when(F.size(parts) == 2, F.get(parts, F.lit(0))),
    )


def _last_wins(doc: Column) -> Column:
    """Drop the earlier ones of duplicate keys."""

    def rebuild(keys: Column) -> Column:
        kept = F.filter(
            F.map_entries(doc),
            lambda e, i: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i,
        )
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), doc).otherwise(
            F.map_from_entries(kept)
        )

    return let(F.map_keys(doc), rebuild)


def document(payload: Column) -> Column:
    """Top-level keys of a JSON object as `map<string,variant>`; NULL for anything else.

    Of duplicate top-level keys the last one counts.
    """
    return let(
        F.from_json(_guarded(payload), "array<map<string,variant>>", _STRICT),
        lambda parts: F.when(
            (F.size(parts) == 2) & (F.size(F.get(parts, F.lit(1))) == 0),
            _last_wins(F.get(parts, F.lit(0))),
        ),
    )


def object_keys(payload: Column) -> Column:
    """Top-level keys when the text is exactly one JSON object, else NULL."""
    return let(
        F.from_json(_guarded(payload), "array<map<string,string>>", _STRICT),
        lambda parts: F.when(
            (F.size(parts) == 2) & (F.size(F.get(parts, F.lit(1))) == 0),
            F.map_keys(F.get(parts, F.lit(0))),
        ),
    )


def with_document(df: DataFrame, payload: str, out: str = "_doc") -> DataFrame:
    """Parse `payload` once into the working column `out`."""
    return bind(df, **{out: document(F.col(payload))})


# --- paths and pointers -----------------------------------------------------------------


def _segment(name: str) -> str:
    return '["' + name.replace("\\", "\\\\").replace('"', '\\"') + '"]'


def dotted_path(path: str) -> str:
    """`a.b` as a quoted variant path."""
    return "$" + "".join(_segment(p) for p in path.split("."))


def pointer_segments(pointer: str) -> list[str]:
    """Reference tokens of an RFC 6901 pointer."""
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise ValueError(f"not a JSON pointer: {pointer!r}")
    return [p.replace("~1", "/").replace("~0", "~") for p in pointer[1:].split("/")]


def pointer_paths(pointer: str) -> list[str]:
    """Variant paths a pointer can mean: a numeric token names an index or a key."""
    choices = []
    for token in pointer_segments(pointer):
        keyed = _segment(token)
        indexed = token.isdigit() and (token == "0" or not token.startswith("0"))
        choices.append([keyed, f"[{token}]"] if indexed else [keyed])
    return ["$" + "".join(combo) for combo in product(*choices)]


def at_pointer(value: Column, pointer: str) -> Column:
    """Variant at a pointer; SQL NULL when it leads nowhere, VOID for a JSON null."""
    found = [F.try_variant_get(value, path, "variant") for path in pointer_paths(pointer)]
    return found[0] if len(found) == 1 else F.coalesce(*found)


def variant_type(value: Column) -> Column:
    """Leading type word: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def array_items(value: Column) -> Column:
    """Elements of a variant array; NULL when it is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


NUMERIC = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def scalar_text(value: Column) -> Column:
    """String as is, number or boolean as its JSON text, NULL for the rest.

    A number with a fraction of zeros keeps one of them: a variant has it as a decimal without
    places, where a whole number within 18 digits is a BIGINT.
    """

    def text(v: Column) -> Column:
        plain = F.try_variant_get(v, "$", "string")
        return F.when(
            F.schema_of_variant(v).rlike(r"^DECIMAL\((?:\d|1[0-8]),0\)$"), F.concat(plain, F.lit(".0"))
        ).when(variant_type(v).isin("STRING", "BOOLEAN", *NUMERIC), plain)

    return let(value, text)


def pointer_text(payload: Column, pointer: str) -> Column:
    """Scalar at a pointer of a JSON text, as text (row keys)."""
    return scalar_text(at_pointer(F.try_parse_json(payload), pointer))


class Field:
    """Type-checked access to a dotted path of a parsed record.

    Every accessor is NULL when the field is absent or of another type, and a NULL
    condition drops the row in `keep`: a filter fails closed on what it cannot read.
    """

    def __init__(self, doc: Column, path: str):
        head, _, rest = path.partition(".")
        self.value = doc[head]
        if rest:
            self.value = F.try_variant_get(self.value, dotted_path(rest), "variant")

    def _typed(self, kinds: tuple[str, ...], cast: str) -> Column:
        return let(
            self.value,
            lambda v: F.when(variant_type(v).isin(*kinds), F.try_variant_get(v, "$", cast)),
        )

    def text(self) -> Column:
        return self._typed(("STRING",), "string")

    def number(self) -> Column:
        return self._typed(NUMERIC, "double")

    def boolean(self) -> Column:
        return self._typed(("BOOLEAN",), "boolean")

    def size(self) -> Column:
        """Length of an array, string or object."""
        members = F.try_variant_get(self.value, "$", "map<string,variant>")
        return F.coalesce(
            F.array_size(array_items(self.value)),
            F.when(members.isNotNull(), F.size(members)),
            F.length(self.text()),
        )

    def contains(self, needle: str) -> Column:
        return self.text().contains(needle)

    def as_text(self) -> Column:
        return scalar_text(self.value)

    def exists(self) -> Column:
        return self.value.isNotNull()

    def is_null(self) -> Column:
        return F.is_variant_null(self.value)


# --- rebuilding -------------------------------------------------------------------------


def object_members(fields: Mapping[str, Any]) -> Column:
    """`"k":v,...` text of the given fields, explicit nulls, without the braces."""
    return let(object_text(fields), lambda text: text.substr(F.lit(2), F.length(text) - 2))


def object_text(fields: Mapping[str, Any]) -> Column:
    """JSON object text of the given fields with explicit nulls."""
    packed = F.struct(*[as_column(v).alias(k) for k, v in fields.items()])
    return F.to_json(packed, {"ignoreNullFields": "false"})


def splice(payload: Column, members: Column, empty: Column) -> Column:
    """Append members to an object's text and leave every other byte alone."""
    comma = F.when(empty, F.lit("")).otherwise(F.lit(","))
    head = let(F.rtrim(payload), lambda body: body.substr(F.lit(1), F.length(body) - 1))
    return F.concat(head, comma, members, F.lit("}"))


def free_name(keys: Column, key: Column) -> Column:
    """First of `<key>_original`, `<key>_original_2`, ... that is not taken."""
    first = F.concat(key, F.lit("_original"))
    numbered = F.transform(
        F.sequence(F.lit(2), F.size(keys) + 2),
        lambda n: F.concat(first, F.lit("_"), n.cast("string")),
    )
    later = F.filter(numbered, lambda name: ~F.array_contains(keys, name))
    return F.when(F.array_contains(keys, first), F.get(later, F.lit(0))).otherwise(first)


def put_fields(
    df: DataFrame, payload: str, fields: Mapping[str, Any], keys: Column | None = None
) -> DataFrame:
    """Set top-level fields on object rows; what a row already had moves to a free name.

    Rows without a collision are spliced as text; only colliding rows are re-rendered.
    `keys` are the row's keys where the caller has parsed it already; NULL leaves a row as
    it is.
    """
    if not fields:
        return df
    names = list(fields)
    wanted = F.array(*[F.lit(n) for n in names])
    if keys is None:
        keys = object_keys(F.col(payload))
    out = bind(df, _keys=keys).withColumn("_members", object_members(fields))

    def parked(doc: Column) -> Column:
        colliding = F.filter(F.map_entries(doc), lambda e: F.array_contains(wanted, e["key"]))
        moved = let(
            F.array_union(F.map_keys(doc), wanted),
            lambda taken: F.transform(
                colliding,
                lambda e: F.struct(
                    free_name(taken, e["key"]).alias("key"), e["value"].alias("value")
                ),
            ),
        )
        kept = F.map_filter(doc, lambda k, v: ~F.array_contains(wanted, k))
        return F.to_json(
            F.map_concat(kept, F.map_from_entries(moved)), {"ignoreNullFields": "false"}
        )

    clash = F.arrays_overlap("_keys", wanted)
    rebuilt = let(document(F.col(payload)), parked)
    result = (
        F.when(F.col("_keys").isNull(), F.col(payload))
        .when(clash, splice(rebuilt, F.col("_members"), F.lit(False)))
        .otherwise(splice(F.col(payload), F.col("_members"), F.size("_keys") == 0))
    )
    # A projection, not a binding: a report that needs no payload does not build it.
    return out.withColumn(payload, result).drop("_keys", "_members")
