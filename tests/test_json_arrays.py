"""JSON arrays in ranges against the multi-line reader."""

import json
import random

import pytest

from lorefield.sources import json_arrays, tables

ODD = ['plain', 'a } b', 'a { [ b', 'quote \\" } ', '\\\\', 'back \\\\" no', '}}}', ']', '},{', 'é日\u2028', '', 'line\nbreak', '\t', '"', '\\', '\\"']


def value(rng, depth=0):
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind == 4:
        return [value(rng, 4) for _ in range(rng.randint(0, 3))]
    if kind >= 5:
        return {rng.choice("abc}{"): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [rng.choice(ODD), rng.randint(-9, 9), None, True][kind]


def small_ranges(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture()
def ranges(spark):
    before = {k: spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes")}
    yield lambda size: small_ranges(spark, size)
    for k, v in before.items():
        spark.conf.set(f"spark.sql.files.{k}", v)


@pytest.mark.parametrize("size", ["150b", "1500b", "1m"])
def test_elements_of_cut_files(spark, tmp_path, ranges, size):
    rng = random.Random(size)
    want = []
    for k, style in enumerate(({}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False})):
        rows = [{"id": f"{k}-{i}", "v": value(rng)} for i in range(25)]
        want += [json.dumps(r, sort_keys=True) for r in rows]
        (tmp_path / f"{k}.json").write_text(("\ufeff" if k == 1 else "  ") + json.dumps(rows, **style) + "\n", encoding="utf-8")
    long = [{"id": "long", "v": "}" * 700}, {"id": "deep", "v": [[{"x": [{}] * 40}]]}]
    (tmp_path / "long.json").write_text(json.dumps(long))
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "other.json").write_text('[1, "a}", [2, {"no": 1}], null, {"id": "last"}]')
    (tmp_path / "one.json").write_text('{"id": "one", "v": {"w": "}"}}')
    (tmp_path / "lines.json").write_text('{"id": "l1"}\n{"id": "l2", "v": "}{"}\n')
    want += [json.dumps(r, sort_keys=True) for r in [*long, {"id": "last"}, {"id": "one", "v": {"w": "}"}}, {"id": "l1"}, {"id": "l2", "v": "}{"}]]
    ranges(size)
    found = json_arrays.array_elements(spark, str(tmp_path))
    got = [json.dumps(json.loads(r.value), sort_keys=True) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_tables_equal_the_multi_line_reader(spark, tmp_path, ranges):
    rng = random.Random(1)
    for k in range(3):
        rows = [{"id": i, "text": rng.choice(ODD), "x": rng.choice([1.5, None]), "tags": ["a}", "b"], "sub": {"k": rng.choice(ODD)}} for i in range(40)]
        (tmp_path / f"{k}.json").write_text(json.dumps(rows, indent=rng.choice([None, 1])))
    whole = tables.read_table(spark, str(tmp_path), "json")
    ranges("200b")
    cut = tables.read_table(spark, str(tmp_path), "json", ranges_from=0)
    assert cut.schema == whole.schema
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect())) and cut.count() == 120
    given = "id bigint, text string"
    assert sorted(map(str, tables.read_table(spark, str(tmp_path), "json", given, ranges_from=0).collect())) == sorted(
        map(str, tables.read_table(spark, str(tmp_path), "json", given).collect()))


def test_scanner_states():
    assert json_arrays.scan('[{"a": "x', False, 0) == (True, 2, 1, False)
    assert json_arrays.scan('\\" still', True, 2) == (True, 2, -1, False)
    assert json_arrays.scan('end", "b": [1, {"c": 2', True, 2) == (False, 4, -1, False)
    assert json_arrays.scan(', {"d": {"e": 1', False, 1) == (False, 3, 2, False)
    assert json_arrays.scan('], {"d": 1', False, 2) == (False, 2, 3, True)
