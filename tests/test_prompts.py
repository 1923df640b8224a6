from pyspark.sql import functions as F

from labelloom.functions import prompts
from labelloom.functions.values import named

# Written out here on purpose: the text must not change.
HEAD = (
    "You are given a programming problem with various details. Your task is to analyze the problem and determine "
    "which tags apply from the following list:\na, b c.\n\nFor each tag, output 1 if the tag applies to the problem "
    "or 0 if it does not.\nIt is important that you consider that none of the tags might apply, and that multiple "
    "tags may apply simultaneously.\nIMPORTANT: Your output must be a single valid JSON object, and it must be "
    'wrapped between <output> and </output>.\nThe JSON object must only contain the following keys: "a", "b c".\n'
    "Each key must have either the value 0 or 1.\n\nBelow are the problem details:"
)
TAIL = (
    "Respond with only one JSON response wrapped in <output> and </output> with no additional text.\n"
    'For example:\n<output>{"a": 1, "b c": 0}</output>'
)


def test_prompt_leaves_out_nulls_and_keeps_empty_texts(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, "y", "")], "i int, problem_description string, problem_notes string")
    prompt = prompts.build_prompt(["problem_description", "problem_notes"], ["a", "b c"])
    found = [r[0] for r in rows.orderBy("i").select(prompt).collect()]
    assert found[0] == f"{HEAD}\nProblem description: x\n\n{TAIL}"
    assert found[1] == f"{HEAD}\nProblem description: y\nProblem notes: \n\n{TAIL}"


def test_gold_output_and_training_text(spark):
    rows = spark.createDataFrame([(1, 0)], "a int, `b c` int")
    gold = prompts.gold_output({"a": named("a"), "b c": named("b c"), 'q"': None})
    assert rows.select(gold).first()[0] == '<output>{"a": 1, "b c": 0, "q\\"": 0}</output>'
    text = prompts.sft_text(F.lit("p"), F.lit("o"), "END")
    assert rows.select(text).first()[0] == "p\noEND"


def test_input_text_strips_all_white_space(spark):
    rows = spark.createDataFrame([("  \n", " x", None), ("a", None, "b\t")], "a string, b string, c string")
    found = [r[0] for r in rows.select(prompts.input_text(["a", "b", "c"])).collect()]
    assert sorted(found) == ["a\n\nb", "x"]


def test_chat_ends_in_an_open_turn(spark):
    text = spark.range(1).select(prompts.chat_text(F.lit("hi"), "sys")).first()[0]
    assert text == "<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"


def test_strip_prompt(spark):
    rows = spark.createDataFrame([([1, 2], [1, 2, 3, 4]), ([], [5]), ([7], [7]), ([], [])], "p array<int>, o array<int>")
    found = [r[0] for r in rows.select(prompts.strip_prompt(F.col("o"), F.col("p"))).collect()]
    assert found == [[3, 4], [5], [], []]
