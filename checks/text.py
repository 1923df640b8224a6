"""Prompts, answers and token arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.views import FLAGS, SCORED_SQL, scored, table
from labelloom.functions import prompts
from labelloom.functions.values import named
from labelloom.operators import answers


def sql_quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PROMPT_COLUMNS = ["text", "source_name", "n_chars"]
# ---- Fixed values: the prompt text the SQL must give --------------------------------
TEMPLATE = """You are given a programming problem with various details. Your task is to analyze the problem and determine which tags apply from the following list:
quality, toxic, english, long text.

For each tag, output 1 if the tag applies to the problem or 0 if it does not.
It is important that you consider that none of the tags might apply, and that multiple tags may apply simultaneously.
IMPORTANT: Your output must be a single valid JSON object, and it must be wrapped between <output> and </output>.
The JSON object must only contain the following keys: "quality", "toxic", "english", "long text".
Each key must have either the value 0 or 1.

Below are the problem details:
"""
CLOSING = """
Respond with only one JSON response wrapped in <output> and </output> with no additional text.
For example:
<output>{"quality": 1, "toxic": 0, "english": 1, "long text": 0}</output>"""
PROMPT_SQL = f"""{sql_quote(TEMPLATE)} || 'Text: ' || text || chr(10)
  || CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Source name: ' || source || chr(10) END
  || 'N chars: ' || CAST(n_chars AS VARCHAR) || chr(10) || {sql_quote(CLOSING)}"""
OUTPUT_SQL = """'<output>{"quality": ' || CAST(quality AS VARCHAR) || ', "toxic": ' || CAST(toxic AS VARCHAR)
  || ', "english": ' || CAST(english AS VARCHAR) || ', "long text": ' || CAST("long text" AS VARCHAR) || '}</output>'"""


def prompt_rows(spark, sf):
    """Scored documents; every third has no source name."""
    return scored(spark, sf).withColumn("source_name", F.when(F.col("doc_id") % 3 != 0, F.col("source")))


def gold():
    return prompts.gold_output({f: named(f) for f in FLAGS})


@query("build_prompt", f"WITH {SCORED_SQL} SELECT doc_id, {PROMPT_SQL} AS prompt FROM scored")
def build_prompt(spark, sf):
    return prompt_rows(spark, sf).select("doc_id", prompts.build_prompt(PROMPT_COLUMNS, FLAGS).alias("prompt"))


@query("gold_output", f"WITH {SCORED_SQL} SELECT doc_id, {OUTPUT_SQL} AS output FROM scored")
def gold_output(spark, sf):
    return scored(spark, sf).select("doc_id", gold().alias("output"))


@query(
    "sft_text",
    f"WITH {SCORED_SQL} SELECT doc_id, {PROMPT_SQL} || chr(10) || {OUTPUT_SQL} || '<|endoftext|>' AS text FROM scored",
)
def sft_text(spark, sf):
    prompt = prompts.build_prompt(PROMPT_COLUMNS, FLAGS)
    return prompt_rows(spark, sf).select("doc_id", prompts.sft_text(prompt, gold()).alias("text"))


@query(
    "input_text",
    """SELECT doc_id, regexp_replace(regexp_replace(CASE WHEN doc_id % 3 = 0 THEN '' ELSE '  ' || source || chr(10) || chr(10) END
       || text || chr(10) || chr(10) || ' ' || lang || ' ' || chr(10), '^[ \\n\\r\\t]+', ''), '[ \\n\\r\\t]+$', '') AS input_text
       FROM documents""",
)
def input_text(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("  "), "source")).alias("source"),
        F.concat(F.lit(" "), "lang", F.lit(" \n")).alias("lang"),
    )
    return rows.select("doc_id", prompts.input_text(["source", "text", "lang"]).alias("input_text"))


@query(
    "chat_text",
    """SELECT conv_id, turn, '<|im_start|>system' || chr(10) || 'Label the text.<|im_end|>' || chr(10)
       || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS chat
       FROM conversations""",
)
def chat_text(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", prompts.chat_text(F.col("text"), "Label the text.").alias("chat"))


@query(
    "conversation_text",
    """SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                                  ORDER BY turn, role, text) || '<|im_start|>assistant' || chr(10) AS chat
       FROM conversations GROUP BY conv_id""",
)
def conversation_text(spark, sf):
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return grouped.select("conv_id", prompts.conversation_text(F.col("turns")).alias("chat"))


@query(
    "strip_prompt",
    """SELECT doc_id, array_to_string(words[n_chars % len(words) + 1:], ' ') AS answer
       FROM (SELECT doc_id, n_chars, string_split(text, ' ') AS words FROM documents)""",
)
def strip_prompt(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", "n_chars", F.split("text", " ").alias("output_ids"))
    size = (F.col("n_chars") % F.size("output_ids")).cast("int")
    prompted = words.withColumn("input_ids", F.slice("output_ids", F.lit(1), size))
    answer = prompts.strip_prompt(F.col("output_ids"), F.col("input_ids"))
    return prompted.select("doc_id", F.array_join(answer, " ").alias("answer"))


# ---- answers -----------------------------------------------------------------------
# Every event's props ({"k": 69}) become an answer of one of twelve forms. The labels
# are k and "b c". The SQL states what each form must give.

ANSWER_LABELS = ["k", "b c"]
BIT = "CAST(json_extract_string(props, '$.k') AS INTEGER) % 2"
# Form -> (SQL for k, SQL for "b c", status, SQL for the vector of labels_from_output)
EXPECTED = {
    0: (BIT, "0", "tagged"),
    1: (BIT, "1", "tagged"),
    2: ("1", "1", "tagged"),
    3: ("0", "0", "error"),
    4: (BIT, "0", "fallback"),
    5: ("0", "0", "error"),
    6: ("0", "0", "error"),
    7: (BIT, "1", "tagged"),
    8: (BIT, "0", "fallback"),
    9: ("0", "0", "error"),
    10: ("1", "0", "tagged"),
    11: ("0", "0", "error"),
}


def _case(values: dict[int, str]) -> str:
    return "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN {v}" for i, v in values.items()) + " END"


def answer_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    bit = (k % 2).cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    forms = [
        text('<output>{"k": ', bit, "}</output>"),
        text('Sure.\n<OUTPUT>\n {"b c": 1, "k":', bit, "}\n</Output> done"),
        text('<output>{"k": true, "b c": "1"}</output>'),
        text('<output>{"k": ', bit, ', "b c": null}</output>'),
        text('The answer is {"k": ', bit, "}."),
        text('<output>{"k": ', bit),
        text("no answer for ", F.col("props").substr(2, 4)),
        text('<output>{"z": {"q": [1, {"y": 2}]}, "k": ', bit, ', "b c": 1}</output>'),
        text('<output>```json\n{"k": ', bit, "}\n```</output>"),
        text('<output>{"k": ', (k % 2 + 2).cast("string"), ', "b c": 1}</output>'),
        text('<output>{"k": 1.9}</output>'),
        text('<output>{"k": ', bit, ",}</output>"),
    ]
    answer = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        answer = F.when(F.col("event_id") % 12 == i, form).otherwise(answer)
    return events.select("event_id", answer.alias("answer"))


@query(
    "parse_model_output",
    f"""SELECT event_id, {_case({i: v[0] for i, v in EXPECTED.items()})} AS pred_k,
        {_case({i: v[1] for i, v in EXPECTED.items()})} AS "pred_b c",
        {_case({i: sql_quote(v[2]) for i, v in EXPECTED.items()})} AS parse_status FROM events""",
)
def parse_model_output(spark, sf):
    return answers.parse_model_output(answer_rows(spark, sf), "answer", ANSWER_LABELS).drop("answer")


@query(
    "parse_status",
    f"""SELECT {_case({i: sql_quote(v[2]) for i, v in EXPECTED.items()})} AS parse_status, count(*) AS n_rows
        FROM events GROUP BY 1""",
)
def parse_status(spark, sf):
    return answers.parse_status(answer_rows(spark, sf), "answer", ANSWER_LABELS)


# A vector has no fallback, and 1.9 is not exactly 0 or 1.
_STRICT = {i: v if v[2] == "tagged" and i != 10 else ("0", "0") for i, v in EXPECTED.items()}


@query(
    "labels_from_output",
    f"""SELECT event_id, CAST({_case({i: v[0] for i, v in _STRICT.items()})} AS DOUBLE) AS k,
        CAST({_case({i: v[1] for i, v in _STRICT.items()})} AS DOUBLE) AS bc FROM events""",
)
def labels_from_output(spark, sf):
    rows = answers.labels_from_output(answer_rows(spark, sf), "answer", ANSWER_LABELS)
    return rows.select("event_id", F.col("labels")[0].alias("k"), F.col("labels")[1].alias("bc"))
