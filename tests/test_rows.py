"""Row rules, JSON access and builders on hand-made records."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.json import Field, bind, document, pointer_text, with_document
from feedloom.functions.records import cap_values, to_record
from feedloom.operators import builders, decode, paging, rules
from feedloom.operators.unwrap import unwrap_nested, unwrap_text


def rows(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")


def texts(df, column="payload"):
    return [r[column] for r in df.orderBy("id").collect()]


def test_filter_fails_open_on_non_objects_and_closed_on_everything_else(spark):
    df = rows(
        spark,
        '{"n":75}', '{"n":"75"}', '{"n":null}', "{}", "[1]", "plain", '{"n":75}{"n":1}', '{"n":1}',
    )
    parsed = with_document(df, "payload")
    kept = rules.keep(parsed, Field(F.col("_doc"), "n").number() > 50)
    assert texts(kept) == ['{"n":75}', "[1]", "plain", '{"n":75}{"n":1}']


def test_filter_on_a_number_keeps_what_is_not_zero(spark):
    parsed = with_document(rows(spark, '{"n":0}', '{"n":2}', '{"n":true}'), "payload")
    assert texts(rules.keep(parsed, Field(F.col("_doc"), "n").number())) == ['{"n":2}']


def test_field_sizes_and_nested_paths(spark):
    parsed = with_document(
        rows(spark, '{"a":{"b.c":1,"d":[1,2]},"s":"xyz","o":{"k":1}}'), "payload"
    )
    doc = F.col("_doc")
    row = parsed.select(
        Field(doc, "a.d").size().alias("d"),
        Field(doc, "s").size().alias("s"),
        Field(doc, "o").size().alias("o"),
        Field(doc, "s").contains("y").alias("c"),
        Field(doc, "zz").exists().alias("zz"),
    ).first()
    assert tuple(row) == (2, 3, 1, True, False)


def test_added_fields_park_what_was_there(spark):
    df = rows(
        spark,
        '{"k":1}',
        '{"k":1,"k_original":2}',
        '{"k":1,"k_original":2,"k_original_2":3}',
        "{}",
        "[1]",
        ' {"z": {"b":1,"a":1.10}} ',
    )
    out = texts(rules.add_fields(df, {"k": "new"}))
    assert [json.loads(t) for t in out[:4]] == [
        {"k": "new", "k_original": 1},
        {"k": "new", "k_original": 2, "k_original_2": 1},
        {"k": "new", "k_original": 2, "k_original_2": 3, "k_original_3": 1},
        {"k": "new"},
    ]
    assert out[4] == "[1]"
    # Without a collision every byte of the record stays.
    assert out[5] == ' {"z": {"b":1,"a":1.10},"k":"new"}'


def test_last_of_duplicate_keys_counts(spark):
    parsed = rows(spark, '{"a":1,"a":2}').select(Field(document(F.col("payload")), "a").number())
    assert parsed.first()[0] == 2.0


def test_tenancy_and_stamp(spark):
    df = rows(spark, "﻿" + '{"a":1}', '{"a":1', "[1]", "text", '{"_org_id":"me"}')
    out = rules.stamp(df, "s", "c.u", "o", 5, 6)
    got = {r["id"]: r for r in out.collect()}
    assert [got[i]["tenancy"] for i in range(5)] == [
        "Stamped", "Refused", "Unstamped", "Unstamped", "Stamped",
    ]
    assert json.loads(got[0]["payload"]) == {
        "a": 1, "_timestamp_fetcher": 5, "_timestamp_received": 6, "_source": "s",
        "_source_fetcher": "c.u", "_org_id": "o",
    }
    assert got[1]["payload"] == '{"a":1'
    assert json.loads(got[4]["payload"])["_org_id_original"] == "me"


def test_split_bodies(spark):
    df = rows(
        spark,
        '[{"a":1},{"a":2}]',
        "[]",
        '[{"a":1},2]',
        '{"a":1}\n{"a":2}\n',
        '{"a":\n1}\n{"b":{"c":"}\\n"}}',
        '{"a":1}\nnot',
    )
    got = [
        (r["id"], r["part"], r["payload"], r["is_last"])
        for r in rules.split_body(df).orderBy("id", "part").collect()
    ]
    assert got == [
        (0, 0, '{"a":1}', False),
        (0, 1, '{"a":2}', True),
        (2, 0, '[{"a":1},2]', True),
        (3, 0, '{"a":1}', False),
        (3, 1, '{"a":2}', True),
        (4, 0, '{"a":\n1}', False),
        (4, 1, '{"b":{"c":"}\\n"}}', True),
        (5, 0, '{"a":1}\nnot', True),
    ]


def test_unwrap_opens_containers_and_keeps_everything_else(spark):
    record = '{"id":"1","payload":"{\\"inner\\":true,\\"n\\":[1,2]}","note":"{not json"}'
    assert json.loads(unwrap_text(record)) == {
        "id": "1", "payload": {"inner": True, "n": [1, 2]}, "note": "{not json",
    }
    same = '{"a": "1",  "b": "x {"}'
    assert texts(unwrap_nested(rows(spark, same, record)))[0] == same


def test_unwrap_stops_below_the_third_level():
    deep = {"a": {"b": {"c": {"d": '{"e":1}'}}}}
    text = json.dumps(deep)
    assert unwrap_text(text) == text
    shallow = {"a": {"b": {"c": '{"e":1}'}}}
    assert json.loads(unwrap_text(json.dumps(shallow)))["a"]["b"]["c"] == {"e": 1}


def test_pointers(spark):
    df = rows(spark, '{"a/b":{"c~d":[10,{"0":"k"}]},"n":null,"0":"zero"}')
    got = df.select(
        *[
            pointer_text(F.col("payload"), p).alias(f"c{i}")
            for i, p in enumerate(["/a~1b/c~0d/0", "/a~1b/c~0d/1/0", "/n", "/0", "/x"])
        ]
    ).first()
    assert tuple(got) == ("10", "k", None, "zero", None)


def test_array_elements_keep_their_kind(spark):
    df = rows(spark, '["1",1,null,{"b":1,"a":2},"{",[true]]')
    out = decode.explode_array(df.withColumnRenamed("payload", "body"), "body")
    got = [r["payload"] for r in out.orderBy("pos").collect()]
    assert got[:3] == ['"1"', "1", "null"]
    assert json.loads(got[3]) == {"b": 1, "a": 2}
    assert got[4:] == ['"{"', "[true]"]


def test_array_with_repeated_nested_keys_keeps_its_elements(spark):
    df = rows(spark, '[{"a":{"x":1,"x":2}},{"b":1}]').withColumnRenamed("payload", "body")
    got = [r["payload"] for r in decode.explode_array(df, "body").orderBy("pos").collect()]
    assert got == ['{"a":{"x":1,"x":2}}', '{"b":1}']


def test_incomplete_array_is_an_error(spark):
    df = rows(spark, '[{"a":1}').withColumnRenamed("payload", "body")
    with pytest.raises(Exception, match="not a complete JSON array"):
        decode.explode_array(df, "body").collect()


def test_csv_records():
    text = 'a,b\r\n1,"x, ""y""\nz",3\r\n\r\n4\r\n'
    assert [json.loads(r) for r in decode.csv_records(text)] == [
        {"a": "1", "b": 'x, "y"\nz', "col_2": "3"},
        {"a": "4"},
    ]
    assert json.loads(next(decode.csv_records("1,2\n", header=False))) == {"col_0": "1", "col_1": "2"}


def test_record_profiles(spark):
    df = spark.sql(
        "select cast(12345678901234567890.5 as decimal(30,2)) d, cast(1.50 as decimal(10,2)) e, "
        "double('NaN') f, timestamp'2024-01-02 03:04:05.5' t, date'2024-01-02' y, "
        "binary('ab') b, cast(null as int) n, 9007199254740993L l"
    )
    odbc = json.loads(df.select(to_record(df, "odbc")).first()[0])
    assert odbc["t"] == "2024-01-02T03:04:05.500000Z" and odbc["n"] is None
    assert odbc["l"] == 9007199254740993 and odbc["f"] == "NaN" and odbc["b"] == "YWI="
    hana = json.loads(df.select(to_record(df, "hana")).first()[0])
    assert hana["d"] == "12345678901234567890.50" and hana["e"] == 1.5
    assert hana["t"].endswith(".500000")
    ext = json.loads(df.select(to_record(df, "extjson")).first()[0])
    assert ext["t"] == {"$date": "2024-01-02T03:04:05.500Z"}
    assert ext["b"] == {"$binary": {"base64": "YWI=", "subType": "00"}}


def test_caps_fail_and_never_cut(spark):
    df = spark.createDataFrame([("a" * 5, b"x"), ("ä" * 3, b"xxxx")], "t string, b binary")
    kept, refused = cap_values(df, 5, 3)
    assert [r["t"] for r in kept.collect()] == ["aaaaa"]
    assert [r["too_large"] for r in refused.collect()] == [["t", "b"]]


def test_version_fold_later_document_of_a_version_wins(spark):
    df = spark.createDataFrame(
        [("m", i, json.dumps({"Version": v, "i": i})) for i, v in enumerate(["v1", "v2", "v1"])],
        "key string, pos long, doc string",
    )
    out = builders.version_fold(df, "key", "pos", "doc", F.lit(0))
    assert json.loads(out.first()["payload"]) == {
        "versions": ["v1", "v2", "v1"],
        "version_info": {"v1": {"Version": "v1", "i": 2}, "v2": {"Version": "v2", "i": 1}},
    }


@pytest.mark.parametrize(
    "link,target",
    [
        ('<https://h/a>; rel="next"', "https://h/a"),
        ("<https://h/a>; rel=next", "https://h/a"),
        ('<https://h/p>; rel="prev", <https://h/n>; rel="next"', "https://h/n"),
        ('<https://h/p>; title="x"; rel="next"', "https://h/p"),
        ('<https://h/p>; rel="last"', None),
        ("", None),
    ],
)
def test_link_next(spark, link, target):
    df = spark.createDataFrame([({"link": link},)], "headers map<string,string>")
    assert df.select(paging.link_next(F.col("headers"))).first()[0] == target


@pytest.mark.parametrize(
    "base,target,full",
    [
        ("https://h/a/b?x=1", "https://o/c", "https://o/c"),
        ("https://h/a/b?x=1", "/c", "https://h/c"),
        ("https://h/a/b?x=1", "c?y", "https://h/a/c?y"),
        ("https://h/a/b?x=1", "?y=2", "https://h/a/b?y=2"),
        ("https://h", "c", "https://h/c"),
        ("https://h/a", "//o/c", "https://o/c"),
    ],
)
def test_join_url(spark, base, target, full):
    assert spark.range(1).select(paging.join_url(F.lit(base), F.lit(target))).first()[0] == full


def test_tokens(spark):
    df = rows(spark, '"a"', "7", "[1,\"b\"]", "[1,null]", "[]", '""', "null", "{}")
    got = df.select("id", paging.token_text(F.try_parse_json("payload")).alias("t"))
    assert texts(got, "t") == ["a", "7", "1,b", None, None, None, None, None]


def test_bind_replaces_columns_and_keeps_null(spark):
    out = bind(rows(spark, "a", None), payload=F.upper("payload"), n=F.length("payload"))
    assert [(r["payload"], r["n"]) for r in out.orderBy("id").collect()] == [("A", 1), (None, None)]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=5), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.text(max_size=6), json_values, max_size=5), min_size=5, max_size=30))
def test_added_field_leaves_the_rest_of_any_record(spark, records):
    df = rows(spark, *[json.dumps(r) for r in records])
    out = [json.loads(t) for t in texts(rules.add_fields(df, {"k": 1}))]
    for before, after in zip(records, out):
        want = {("k_original" if k == "k" and "k_original" not in before else k): v for k, v in before.items()}
        if "k" not in before:
            assert after == {**want, "k": 1}
        else:
            assert after["k"] == 1 and before["k"] in after.values()
