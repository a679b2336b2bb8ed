"""Reading model responses: answers, scores, question-answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lorefield.functions.strings import as_column, once, strip, unescape_text

# Texts stored for responses that cannot be used.
CALL_FAILED = "API调用失败: "
NO_RESPONSE = "模型无回应"
NO_REASON = "无原因"
REASON_NOT_FOUND = "未找到具体原因"
UNREADABLE = "无法解析评测结果: "

# The patterns of a judge's response and of a QA pair.
FENCED_JSON = r"(?is)```(?:json)?\s*(\{.*?\})\s*```"
# (Possessive repeats: the Java engine recurses for a repeated group that may be given back.)
BRACED_JSON = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*+\}"
BARE_SCORE = r'"?score"?\s*:\s*([0-9.]+)'
BARE_REASON = r'"?reason"?\s*:\s*"([^"]*)"'
QA_PAIR = r"(?s)-?\s*question: (.*?)\s*-?\s*answer: (.+)"


def extract_answer(response: Column | str) -> Column:
    """The answer text of a JSON response, or a failure note, unescaped."""
    raw = as_column(response)
    field = lambda path: F.nullif(F.get_json_object(raw, path), F.lit(""))
    answer = F.coalesce(field("$.answer"), field("$.data.answer"), field("$.choices[0].message.content"), raw)
    error = F.get_json_object(raw, "$.error")
    return F.when(error.isNotNull(), F.concat(F.lit(CALL_FAILED), error)).otherwise(unescape_text(answer))


def _first_json(texts: Column) -> Column:
    """The first text that is one JSON value and nothing else, as the only element of an array.

    The brackets make text after the value an error, which it is not by itself.
    """
    listed = F.transform(texts, lambda t: F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))))
    single = lambda v: (F.try_variant_get(v, "$[0]", "variant").isNotNull()
                        & F.try_variant_get(v, "$[1]", "variant").isNull())
    return F.get(F.filter(listed, single), F.lit(0))


def _judged(listed: Column) -> Column:
    """Score and reason of a parsed response, with the defaults for absent keys."""
    score = F.try_variant_get(listed, "$[0].score", "double")
    reason = F.try_variant_get(listed, "$[0].reason", "string")
    return F.when(listed.isNotNull(), F.struct(
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.coalesce(unescape_text(reason), F.lit(NO_REASON)).alias("reason"),
    ))


def parse_judgement(response: Column | str) -> Column:
    """``struct<score, reason>`` of a judge's response.

    Tried in turn: the whole text as JSON, the first fenced block, each braced
    part, the bare patterns. What remains scores 0 and quotes the response.
    """
    raw = as_column(response)
    silent = F.struct(F.lit(0.0).alias("score"), F.lit(NO_RESPONSE).alias("reason"))
    return F.when(raw.isNull() | (raw == ""), silent).otherwise(once(unescape_text(raw), _verdict))


def _verdict(text: Column) -> Column:
    fenced = F.regexp_extract(text, FENCED_JSON, 1)
    braced = F.regexp_extract_all(text, F.lit(BRACED_JSON), F.lit(0))
    found = _first_json(F.concat(F.array(strip(text), fenced), braced))
    number = F.regexp_extract(text, BARE_SCORE, 1)
    reason = F.when(text.rlike(BARE_REASON), unescape_text(F.regexp_extract(text, BARE_REASON, 1)))
    bare = F.when(number != "", F.struct(
        F.coalesce(number.try_cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(reason, F.lit(REASON_NOT_FOUND)).alias("reason"),
    ))
    quoted = F.concat(F.lit(UNREADABLE), F.substring(text, 1, 100), F.lit("..."))
    unread = F.struct(F.lit(0.0).alias("score"), unescape_text(quoted).alias("reason"))
    return F.coalesce(once(found, _judged), bare, unread)


def parse_qa(response: Column | str) -> Column:
    """``struct<question, answer>`` of a generated pair, null without a match."""
    text = as_column(response)
    question = strip(F.regexp_extract(text, QA_PAIR, 1))
    answer = strip(F.regexp_extract(text, QA_PAIR, 2))
    return F.when(text.rlike(QA_PAIR), F.struct(question.alias("question"), answer.alias("answer")))


def valid_qa(question: Column | str, answer: Column | str) -> Column:
    """Both present, long enough, and of plausible relative length."""
    q, a = as_column(question), as_column(answer)
    held = ((q != "") & (a != "") & (F.length(strip(q)) >= 5) & (F.length(strip(a)) >= 10)
            & (F.length(a) <= F.length(q) * 50))
    return F.coalesce(held, F.lit(False))
