"""JSON files that are split while they are read, against whole-file parsing."""

import json
import random

import pytest

from millrace.sources import arrays, files


def whole(text: str):
    """Distinct records in order, or None for a file that is no array or object."""
    try:
        data = json.loads(text, parse_constant=lambda _: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return None
    if not isinstance(data, (list, dict)):
        return None
    out = []
    for record in data if isinstance(data, list) else [data]:
        text = json.dumps(record, sort_keys=True)
        out += [text] if text not in out else []
    return out


def value(rng, depth):
    kind = rng.randint(0, 7 if depth else 4)
    if kind == 0:
        return rng.choice(['a"b', "}", "{", "]}", '\\', '\\"', "é}ü", "\n", "x" * rng.randint(0, 60), "[", '"}, {"', ""])
    if kind < 5:
        return rng.choice([None, True, 7, -1, "plain", "\u2028"])
    if kind == 5:
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["k", "}", '"', "a b"]) + str(i): value(rng, depth - 1) for i in range(rng.randint(0, 4))}


def spelled(rng, n):
    records = [value(rng, 3) if rng.random() < 0.2 else {"id": rng.randint(0, n), "v": value(rng, 3)} for _ in range(n)]
    return json.dumps(records, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]), separators=rng.choice([None, (",", ":")]))


def damage(rng, text):
    at = rng.randrange(len(text))
    return text[:at] + rng.choice(["", "}", "{", '"', ",", "]", "\\", " x", "}{"]) + text[at + rng.randint(0, 2) :]


FIXED = [
    "[]", " [ ] ", "{}", " {\n} ", '{"a":{"b":1}}', '{"a":1} ', '{"a":1}{"b":2}', '{"a":1} x', "5", "", "  ", "null", "[1,2,1]", "[[{}],[{}]]",
    '[{"a":1},]', '[,{"a":1}]', '[{"a":1} {"b":2}]', '[{"a":1}', '[{"a":1}]]', '[{"a":1}}]', '}[{"a":1}]', '[{"a":1}] ', '[{"a":1}]\n{"b":2}',
    '[{"a":"\\\\"},{"b":"\\""}]', '["}",{"a":"}"},"}"]', '[{"a":1}, 2, 3]', '[1, {"a":1}]', '[{"a":1}],[{"b":1}]', '[{"a":"x}]', '\ufeff[{"a":1}]',
    '{"a":1}]', '[{"a":1}\n,\n{"a":1}\n]\n', '[{"a":1},]{"b":1}',
]


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_split_equals_whole(spark, tmp_path, block):
    rng = random.Random(block)
    texts = FIXED + [spelled(rng, rng.randint(0, 40)) for _ in range(25)]
    texts += [damage(rng, spelled(rng, rng.randint(1, 25))) for _ in range(40)]
    names = {}
    for i, text in enumerate(texts):
        path = tmp_path / f"f {i} [+%20].json"
        path.write_bytes(text.encode())
        names[f"file:{path}"] = text
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found, records = arrays.split(spark, sorted(names), files.elements)
        broken = {r.file_path: r.broken for r in found.collect()}
        rows = sorted((r.file_path, r.pos, r.payload) for r in records.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for path, pos, payload in rows:
        assert pos == len(got.setdefault(path, []))
        got[path].append(json.dumps(json.loads(payload), sort_keys=True))
    for path, text in names.items():
        want = whole(text)
        assert broken.get(path, True) == (want is None), text
        assert got.get(path, []) == (want or []), text


def test_one_file_fills_many_tasks_and_its_hash_does_not_depend_on_the_cuts(spark, tmp_path):
    path = tmp_path / "big.json"
    records = [{"id": i, "text": "}" * (i % 7), "nested": {"a": [{"b": i}]}} for i in range(900)]
    records.insert(450, {"id": "long", "text": "y" * 30_000})  # lies across several blocks
    path.write_text(json.dumps(records))
    hashes = set()
    for block in (3000, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        try:
            parts = arrays._fragments(spark, [f"file:{path}"]).select("block").distinct().count()
            assert parts > 10 if block == 3000 else parts == 1
            found, rows = arrays.split(spark, [f"file:{path}"], files.elements)
            hashes.add(found.first().file_hash)
            got = [json.loads(r.payload) for r in rows.orderBy("pos").collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
        assert got == records
    assert len(hashes) == 1
    path.write_text(json.dumps(records[::-1]))
    assert arrays.split(spark, [f"file:{path}"], files.elements)[0].first().file_hash not in hashes


def test_parts_beyond_any_value_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "LONGEST_PART", 100)
    tmp_path = tmp_path / "erp/2026-01-06"
    tmp_path.mkdir(parents=True)
    (tmp_path / "long.json").write_text(json.dumps([{"a": "x" * 500}, {"b": 1}]))
    (tmp_path / "flat.json").write_text(json.dumps(["x" * 500]))
    paths = [f"file:{tmp_path}/{name}.json" for name in ("long", "flat")]
    rows = files.parse_split(spark, paths).select("reason", "payload").collect()
    assert [tuple(r) for r in rows] == [("unreadable JSON", None)] * 2
