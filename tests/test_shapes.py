import json
import os

from pyspark.sql import functions as F

from gristmill.operators import convert, report


def record(**changes):
    text = {"type": "string", "format": "utf-8", "string": "t"}
    image = {"type": "relative_path", "format": "image/png", "relative_path": "a.png", "width": 0, "height": 0} | changes.pop("image", {})
    user = {"role": "user", "content": [{"type": "image", "image": image}, {"type": "text", "text": text | changes.pop("text", {})}]} | changes.pop("user", {})
    return {"meta_prompt": [""], "data": [user, {"role": "assistant", "content": [{"type": "text", "text": text}]}]} | changes


def faults(spark, lines):
    rows = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, line string").select("n", F.try_parse_json("line").alias("v"))
    got = {r.n: r.fault for r in rows.select("n", convert.typed_fault(F.col("v")).alias("fault")).collect()}
    return [got[n] for n in range(len(lines))]


def test_typed_faults(spark):
    cases = [
        (record(), None), (record(meta_prompt=["", ""]), None), (record(image={"width": True}), None), (record(user={"content": [{"type": "text", "text": {"type": "string", "format": "utf-8", "string": ""}}]}), None),
        (record(meta_prompt=None), "meta_prompt is no list"), (record(meta_prompt=["", "", ""]), "meta_prompt is not known"), (record(meta_prompt=[]), "meta_prompt is not known"), (record(data=None), "data is not two turns"),
        (record(data=[1, 2]), "data[0].role is not user"), (record(user={"content": []}), "data[0].content is no list with items"), (record(user={"content": ["x"]}), "data[0]: item type is not known"),
        (record(user={"role": "assistant"}), "data[0].role is not user"), (record(image={"relative_path": ""}), "data[0]: image.relative_path is no path"), (record(image={"width": None}), "data[0]: image.width is no integer"),
        (record(image={"height": 2.5}), "data[0]: image.height is no integer"), (record(image={"format": "image/gif"}), "data[0]: image.format is not known"), (record(text={"string": None}), "data[0]: text.string is no string"),
        (record(text={"format": 8}, image={"type": 1}), "data[0]: image.type is not relative_path"),
    ]
    lines = [json.dumps(r) for r, _ in cases] + ["[1]", "7", "null", "{bad", "", None]
    assert faults(spark, lines) == [f for _, f in cases] + ["record is no object"] * 6


def test_made_records_have_no_fault(spark):
    raw = spark.createDataFrame([("<image> Instruction: draw", "", "<svg/>", ["a.png"]), ("Instruction: draw", "", "<svg/>", [])], "instruction string, input string, output string, images array<string>")
    made = convert.converted(raw)
    assert "data" in made.columns
    lines = [r[0] for r in made.select(F.to_json(F.struct("meta_prompt", "data"))).collect()]
    assert faults(spark, lines) == [None, None]


def test_a_viewers_pass(spark, tmp_path):
    path = str(tmp_path / "chats")
    os.mkdir(path)
    good = [json.dumps(record(id=i)) for i in range(40)] + [json.dumps({"id": 40, "data": 5}), json.dumps({"id": 41, "data": [{"role": "system", "content": [{"type": "video"}, 3]}, {}]}), "[]"]
    for n in range(3):
        with open(os.path.join(path, f"{n}.txt"), "w") as f:
            f.write("\n".join([*good[n::3], "", "  ", "{cut"]))
    lines = spark.read.text(path)
    whole, picked = report.viewed(lines, 7)
    r = whole.first()
    assert (r.rows, r.rejects, r.roles, r.types, r.formats, r.prompts, r.has_image, r.has_video) == (46, 3, ["assistant", "system", "user"], ["image", "text", "video"], ["image/png"], [""], True, True)
    import hashlib

    ids = [json.loads(p.line).get("id") if p.line != "[]" else None for p in picked.collect()]
    assert ids == sorted([*range(42), None], key=lambda i: hashlib.md5(f"42{'' if i is None else i}".encode()).hexdigest())[:7]
    whole, picked = report.viewed(lines.where("false"), 7)
    assert whole.first().rows in (0, None) and picked.count() == 0


def test_shapes(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": "x"}',), ("{",), (None,)], "line string")
    assert tuple(convert.shapes(rows, "line").first()) == (3, 1, "OBJECT<a: BIGINT, b: STRING>")
