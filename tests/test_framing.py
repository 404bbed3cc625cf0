"""Large bodies cut in chunks: the same rows wherever the chunks end."""

import csv
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.operators import decode, framing


def chunked(spark, bodies, sep, size):
    """Pieces of bodies in chunks of `size` pieces, as a text reader with that separator would give them."""
    rows = []
    for path, text in bodies.items():
        pieces = text.split(sep)
        if pieces and pieces[-1] == "":
            pieces = pieces[:-1]
        rows += [(path, i // size * 100, i, p) for i, p in enumerate(pieces)]
    frame = spark.createDataFrame(rows, "path string, chunk long, i long, value string")
    return frame.repartition(5)


def found(spark, bodies, kind, size, **more):
    sep = "," if kind == "json" else "\n"
    rows = framing.rows_of_pieces(chunked(spark, bodies, sep, size), kind, order=["i"], **more).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.path, r.pos is None, r.pos)):
        out.setdefault(r.path, []).append((r.pos, r.payload and json.loads(r.payload), r.error and True))
    return out


DICE = random.Random(7)
VALUES = [
    1, -2.5, None, True, "", "a,b", 'q"uo\\te', "[{", "]}", "\\", '\\"', "é😀,", {"a": [1, {"b": "x,y"}]}, [], {}, [[], [1, 2]],
    {"k": 'v\\",[', "l": [None, "]"]},
]


def arrays():
    bodies = {}
    for n in range(12):
        values = [DICE.choice(VALUES) for _ in range(DICE.randrange(1, 30))]
        bodies[f"good{n}"] = json.dumps(values, indent=DICE.choice([None, 2]), ensure_ascii=DICE.random() < 0.5)
    bodies |= {"empty": " [ ] ", "one": "[7]", "spaced": ' \n[ 1 , "a" ]\n '}
    for n, bad in enumerate(("{}", "[1,2", "[1,,2]", "[1,]", "[1,2] x", "[1],[2]", '["a,b', "1,2", "[1,2]]", "x[1,2]", "[1,{2]", "[,]")):
        bodies[f"bad{n}"] = bad
    return bodies


def plain_json(bodies):
    out = {}
    for path, text in bodies.items():
        try:
            values = json.loads(text)
            values = values if isinstance(values, list) else None
        except ValueError:
            values = None
        if values is None:
            out[path] = [(None, None, True)]
        elif values:
            out[path] = [(i, v, None) for i, v in enumerate(values)]
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_json_arrays_in_chunks_of_any_size(spark, size):
    bodies = arrays()
    assert found(spark, bodies, "json", size) == plain_json(bodies)


def texts():
    fields = ["a", "", "x y", '"q"', '"a,b"', '"l1\nl2"', '"say ""hi"""', "it's", 'in"side', '""', '"\n\n"', "é😀", '"r\r\nn"']
    bodies = {}
    for n in range(12):
        ends = DICE.choice(["\n", "\r\n"])
        lines = ["h1,h2,h1"] + [",".join(DICE.choice(fields) for _ in range(DICE.randrange(1, 5))) for _ in range(DICE.randrange(20))]
        if n % 3 == 0:
            lines.insert(DICE.randrange(len(lines)), "")
        bodies[f"good{n}"] = ends.join(lines) + DICE.choice(["", ends])
    bodies |= {"mac": "a,b\r1,2\r3,4", "head": "a,b\n", "long": 'a,"b\nc"\n"x\n\ny",2\n', "quoted": '"a\n"\n"b"'}
    bodies |= {"bad0": 'a,b\n1,2\n"x"y,3\n4,5\n', "bad1": 'a\n1\n"open\n2\n', "bad2": '"a"b\n1\n2', "bad3": 'a\n"x\ny"z\n"\n1'}
    return bodies


def plain_csv(bodies, header):
    out = {}
    for path, text in bodies.items():
        rows = []
        try:
            for i, r in enumerate(decode.csv_records(text, header)):
                rows.append((i, json.loads(r), None))
        except csv.Error:
            rows.append((None, None, True))
        if rows:
            out[path] = rows
    return out


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
@pytest.mark.parametrize("header", [True, False])
def test_csv_in_chunks_of_any_size(spark, size, header):
    bodies = texts()
    assert found(spark, bodies, "csv", size, header=header) == plain_csv(bodies, header)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a,"\r', max_size=12), st.booleans())
def test_csv_exit_agrees_with_the_reader(text, quoted):
    state = framing.csv_exit(text, quoted)
    line = ('"' if quoted else "") + text
    try:
        list(framing.csv_rows(line + "\n"))
        want = framing.OUT
    except csv.Error as problem:
        want = framing.QUOTED if "unexpected end" in str(problem) else framing.BROKEN
    assert state == want


def test_many_chunks_are_shuffled_once(spark, monkeypatch):
    bodies = arrays()
    monkeypatch.setattr(framing, "BROADCAST_CHUNKS", 3)
    monkeypatch.setattr(framing, "BROADCAST_BYTES", 0)
    assert found(spark, bodies, "json", 2) == plain_json(bodies)
    bodies = texts()
    assert found(spark, bodies, "csv", 3) == plain_csv(bodies, True)


def test_no_bodies(spark):
    for kind in ("json", "csv"):
        assert found(spark, {}, kind, 1) == {}
