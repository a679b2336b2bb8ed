"""Scalar functions against hand-made expectations and small models."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lorefield.functions import answers, strings
from lorefield.functions.conditions import metadata_condition
from lorefield.functions.links import image_urls, mask_links, plain_keys, restore_links
from lorefield.functions.records import coerce_metadata, fallback_document, record_content, record_title
from lorefield.functions.splitting import SEPARATORS, _pack, _pieces, check_chunking, merge_small, split_one
from lorefield.functions.templates import check_template, clean_values, render_prompt, render_template
from lorefield.functions.vectors import cosine


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v")).alias("o")).collect()]


def test_model_abbreviation(spark):
    names = ["google/gemini-embedding-001", "Qwen3-Embedding-0.6B", "baai/bge-m3", "thenlper/gte-base",
             "text-embedding-3-large", "///", "12", "a/b/"]
    assert column(spark, names, strings.model_abbreviation) == [
        "gem-001", "Qwe-0.6", "bge-3", "gte", "tex-3", "emb", "12", "emb"]


def test_parse_model_id(spark):
    got = column(spark, ["p , m/x", "p/m/x"], strings.parse_model_id)
    assert [tuple(g) for g in got] == [("p", "m/x"), ("p", "m/x")]
    with pytest.raises(Exception, match="not a model identifier"):
        column(spark, ["alone"], strings.parse_model_id)


def test_plain_text_matches_python(spark):
    values = [0.0, 1.5, -2.0, 12345678.0, 1.2345678912e10, 123456789012345.6, 1e15, 1e16, 3e22, 1e-3, 1.5e-4, 1e-5, -7.25e-9,
              1e100, 1e-100, 9999999.0, 10000000.0]
    df = spark.createDataFrame([(v, v > 1) for v in values], "v double, b boolean")
    got = df.select(strings.plain_text(df, "v"), strings.plain_text(df, "b")).collect()
    assert [tuple(g) for g in got] == [(str(v), str(v > 1)) for v in values]


def test_query_kind_and_tokens(spark):
    texts = ["Is it? ", "somewhat", "plain words", "", "  a  b\t c\n"]
    assert column(spark, texts, strings.is_query) == [True, True, False, False, False]
    assert column(spark, texts, strings.token_count) == [2, 1, 2, 0, 3]


def test_stem(spark):
    assert column(spark, ["a/b.c.md", "x", ".md", "d/.txt"], strings.stem) == ["b.c", "x", ".md", ".txt"]


def test_templates(spark):
    df = spark.createDataFrame([("a {b}", None, float("inf"), True), (" nan", "NaN", float("nan"), False)],
                               "a string, b string, c double, d boolean")
    out = [r[0] for r in df.select(render_template(df, " {a}|{b}|{c}|{d}|{zzz} ")).collect()]
    assert out == ["a {b}|||True|", "nan|||False|"]
    symbols = clean_values(df, "symbol").collect()
    assert [tuple(r) for r in symbols] == [("a {b}", "", "∞", "True"), (" nan", "", "", "False")]
    with pytest.raises(ValueError, match="available"):
        check_template("{nope}", df.columns)


def test_prompt_keeps_unknown(spark):
    df = spark.createDataFrame([("q", "o", 3)], "input string, model_output string, n int")
    out = df.select(render_prompt(df, "{{input}} {{generated_output}} {{model_output}} {{n}} {{group}}{{what}}")).first()[0]
    assert out == "q o o 3 {{what}}"


def _judgement_model(text):
    """What a judge's response means, spelled out stage by stage."""
    if not text:
        return 0.0, answers.NO_RESPONSE
    for a, b in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'), ("\\'", "'")):
        text = text.replace(a, b)
    tries = [text.strip()]
    tries += re.findall(r"```(?:json)?\s*(\{.*?\})\s*```", text, re.S | re.I)[:1]
    tries += re.findall(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", text)
    for t in tries:
        try:
            doc = json.loads(t)
            return float(doc.get("score", 0.0)), doc.get("reason", answers.NO_REASON)
        except json.JSONDecodeError:
            continue
    score = re.search(r'"?score"?\s*:\s*([0-9.]+)', text)
    reason = re.search(r'"?reason"?\s*:\s*"([^"]*)"', text)
    if score:
        return float(score.group(1)), reason.group(1) if reason else answers.REASON_NOT_FOUND
    return 0.0, f"{answers.UNREADABLE}{text[:100]}..."


def test_parse_judgement(spark):
    texts = ['{"score": 7, "reason": "ok"}', ' {"score": 8.5}\n', 'x ```json\n{"score": 3, "reason": "a"}\n``` y',
             '```\n{bad}\n``` {"score": 2}', 'in {no} {"score": 4, "x": {"y": 1}, "reason": "n"} out', 'score: 5', '"score" : 6 "reason": "r"',
             "nothing at all " * 12, '{"score": 2} and more', '5 then score: 4', '{"score": 1}, {"score": 2}', "", '{"score": 9, "reason": "line\\nbreak"}', '{"score": 1, "reason": "say \\"hi\\""}', '{"reason": "only"}']
    got = [tuple(g) for g in column(spark, texts, answers.parse_judgement)]
    assert got == [_judgement_model(t) for t in texts]
    assert column(spark, [None], answers.parse_judgement)[0]["reason"] == answers.NO_RESPONSE


def test_parse_and_validate_qa(spark):
    texts = ["- question: Q?\n- answer: A", "question: a b  answer: c\nd ", "no", "- question: x\n\n-answer: y"]
    got = column(spark, texts, answers.parse_qa)
    assert [g and tuple(g) for g in got] == [("Q?", "A"), ("a b", "c\nd"), None, ("x", "y")]
    df = spark.createDataFrame([("long enough", "0123456789"), ("shrt", "0123456789"), ("12345", "short"), ("12345", "x" * 251),
                                (None, "0123456789"), ("", "")], "q string, a string")
    assert [r[0] for r in df.select(answers.valid_qa("q", "a")).collect()] == [True, False, False, False, False, False]


def test_extract_answer(spark):
    texts = ['{"answer": "a\\\\nb"}', '{"answer": "", "data": {"answer": "d"}}', '{"choices": [{"message": {"content": "c"}}]}', '{"x": 1}', '{"error": "e"}']
    assert column(spark, texts, answers.extract_answer) == ["a\nb", "d", "c", '{"x": 1}', answers.CALL_FAILED + "e"]


def _condition_model(meta, c):
    values = [str(meta[n]) for n in c["name"] if meta.get(n) is not None]
    op, want = c["comparison_operator"], (c.get("value") or "").lower()
    if not values:
        return op in ("empty", "is not")
    text = " ".join(values).lower()
    plain = {"contains": want in text, "not contains": want not in text, "start with": text.startswith(want), "end with": text.endswith(want),
             "is": text == want, "is not": text != want, "empty": not text.strip(), "not empty": bool(text.strip())}
    if op in plain:
        return plain[op]
    try:
        a, b = float(text), float(want)
    except ValueError:
        return False
    return {"=": a == b, "≠": a != b, ">": a > b, "<": a < b, "≥": a >= b, "≤": a <= b}.get(op, False)


def test_conditions_match_model(spark):
    values = ["", " ", "Abc", "abc d", "10", " 10.0 ", "1e1", "1_0", "1d", "inf", "nan", "-3", "+.5", "5.", None]
    rows = [(i, {k: v for k, v in (("a", a), ("b", b)) if v is not None}) for i, (a, b) in enumerate(
        (a, b) for a in values for b in ("x", None))]
    df = spark.createDataFrame(rows, "i int, metadata map<string,string>")
    ops = ["contains", "not contains", "start with", "end with", "is", "is not", "empty", "not empty", "=", "≠", ">", "<", "≥", "≤", "before", "after"]
    conditions = [{"name": n, "comparison_operator": op, "value": v} for op in ops for n in (["a"], ["a", "b"], ["zz"]) for v in (("AB", None) if len(op) > 1 else ("10", "nan"))]
    exprs = [metadata_condition({"conditions": [c]}, "metadata").alias(f"c{i}") for i, c in enumerate(conditions)]
    for row in df.select("metadata", *exprs).collect():
        want = [_condition_model(row["metadata"], c) for c in conditions]
        got = list(row)[1:]
        assert got == want, [(row["metadata"], c, g) for c, g, w in zip(conditions, got, want) if g != w][:3]


def test_condition_logic(spark):
    df = spark.createDataFrame([({"a": "1"},), ({"a": "2"},)], "metadata map<string,string>")
    count = lambda spec: df.where(metadata_condition(spec, "metadata")).count()
    one, two = ({"name": ["a"], "comparison_operator": "is", "value": v} for v in "12")
    assert count({"logical_operator": "and", "conditions": []}) == 2
    assert count({"logical_operator": "or", "conditions": []}) == 0
    assert count({"logical_operator": "or", "conditions": [one, two]}) == 2
    assert count({"conditions": [one, two]}) == 0
    with pytest.raises(ValueError):
        metadata_condition({"conditions": [{"name": ["a"], "comparison_operator": "like"}]}, "metadata")


def test_records(spark):
    df = spark.createDataFrame([("7", "", {"title": "", "path": "p/q.md", "x": "v", "y": "w"}), ("8", None, {"path": "p/q.md"}),
                                ("9", "doc", {}), (None, "", {"filename": "f"})], "id string, document string, metadata map<string,string>")
    got = [tuple(r) for r in df.select(record_content("document", "metadata"), record_title("metadata", "id")).collect()]
    assert got == [("v w", ""), ("No content available", "q.md"), ("doc", "Document 9"), ("f", "f")]


def test_metadata_and_fallback(spark):
    df = spark.createDataFrame([("1", "a", None, 2.0, float("nan"))], "id string, s string, t string, d double, n double")
    row = df.select(coerce_metadata(df), fallback_document(df)).first()
    assert row[0] == {"s": "a", "t": "", "d": "2.0", "n": ""} and row[1] == "s: a"


def test_cosine_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-2.0, 0.0]), ([3.0, 4.0], [6.0, 8.0])], "a array<double>, b array<double>")
    got = [tuple(r) for r in df.select(cosine("a", "b"), cosine("a", "b", floor0=False)).collect()]
    assert got == [(0.0, 0.0), (0.0, -1.0), (1.0, 1.0)]
    with pytest.raises(Exception, match="vector sizes differ"):
        df.select(cosine("a", F.array(F.lit(1.0)))).collect()


def _links_model(text):
    """Masking by repeated whole-text replacement, with an ordered map."""
    entries = {}
    for n, m in enumerate(list(re.finditer(r"!\[.*?\]\((.*?)\)", text)), 1):
        entries[f"<img{n}>"] = m.group(0)
        text = text.replace(m.group(0), f"<img{n}>")
    seen = {}
    for m in list(re.finditer(r"\[(.*?)\]\(.*?\)", text)):
        label = m.group(1)
        seen[label] = seen.get(label, 0) + 1
        key = f"<{label}{seen[label] if seen[label] > 1 else ''}>"
        entries[key] = m.group(0)
        text = text.replace(m.group(0), key)
    restored = text
    for key, value in entries.items():
        restored = restored.replace(key, value)
    urls = [re.search(r"\((.*?)\)", entries[k]).group(1) for k in re.findall(r"<img\d+>", text)
            if k in entries and re.search(r"\((.*?)\)", entries[k])]
    return text, list(entries.items()), restored, ";".join(urls)


def test_links_match_model(spark):
    rng = random.Random(5)
    bits = ["![a](u1)", "![a](u1)", "![b](u2)", "[x](l1)", "[x](l2)", "[y](l1)", "[img1](l9)", "[x2](l3)", "[![a](u1)](l4)", "<img1>", "<x>", "[", "](", "!", " ", "\n", "![\n](", "z"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    out = mask_links(df, "t").withColumn("keys", plain_keys("link_map")).select(
        "i", "masked", "link_map", restore_links("masked", "link_map").alias("r"), image_urls("masked", "link_map").alias("u"),
        restore_links("masked", "link_map", F.col("keys")).alias("quick"), F.col("keys").isNotNull().alias("plain"))
    rows = out.collect()
    assert 50 < sum(r["plain"] for r in rows) < 400
    for row in rows:
        assert row["quick"] == row["r"], texts[row["i"]]
        got = (row["masked"], [tuple(e) for e in row["link_map"]], row["r"], row["u"])
        assert got == _links_model(texts[row["i"]]), texts[row["i"]]


def _split_model(text, separators, size, overlap):
    """The same rules without the shortcut for one-character separators."""
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    finer = separators[level + 1:] if separators[level] else ()
    run = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            run.append(piece)
            continue
        yield from _pack(run, size, overlap)
        run = []
        yield from _split_model(piece, finer, size, overlap) if finer else (piece,)
    yield from _pack(run, size, overlap)


def test_split_shortcut_equals_rules():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choice("ab  .\n,c#") for _ in range(rng.randint(0, 60)))
        name, size = rng.choice(list(SEPARATORS)), rng.randint(1, 12)
        assert list(split_one(text, SEPARATORS[name], size, 0)) == list(_split_model(text, SEPARATORS[name], size, 0))


def test_split_goldens():
    assert list(split_one("aaa bbb ccc ddd", ["\n", " ", ""], 8, 0)) == ["aaa bbb", "ccc ddd"]
    assert list(split_one("aaa bbb ccc ddd", ["\n", " "], 8, 4)) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert list(split_one("abcdefghij", [" ", ""], 4, 0)) == ["abcd", "efgh", "ij"]
    assert list(split_one("abcdefghij", [" "], 4, 0)) == ["abcdefghij"]
    assert list(split_one("abcdefgh", [" ", ""], 4, 2)) == ["abcd", "cdef", "efgh"]


def test_merge_small():
    lengths = lambda sizes, minimum: [len(c) for c in merge_small(["x" * n for n in sizes], minimum)]
    assert lengths([10, 10, 90, 10, 95], 100) == [215]
    assert lengths([120, 10], 100) == [130]
    assert lengths([10], 100) == [10]
    assert lengths([10, 95, 100], 100) == [105, 100]
    assert lengths([1, 2], 0) == [1, 2]
    for bad in (("nope", 10, 0, 0), ("recursive", 0, 0, 0), ("recursive", 10, -1, 0), ("recursive", 10, 0, 11)):
        with pytest.raises(ValueError):
            check_chunking(*bad)
