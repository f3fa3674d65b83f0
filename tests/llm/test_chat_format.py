import hashlib
import subprocess
import sys

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from edgeloom.llm import chat_format
from edgeloom.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"
control = st.text(st.sampled_from("<\\|turnexd>é\n "), max_size=30)


def brute(rows):
    found = {}
    for c, t, role, text in rows:
        found.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = []
    for c, turns in found.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.just("assistant"), control), st.one_of(st.none(), control)),
                min_size=1, max_size=5))
def test_round_trip_of_control_strings(turns):
    roles, texts = (pa.array([t[i] for t in turns], pa.string()) for i in (0, 1))
    formatted, start, end = chat_format.assemble(roles, texts)
    whole = "".join(formatted.to_pylist()).encode()
    read = [tuple(map(chat_format.unescape, m)) for m in chat_format._TURN.findall(whole)]
    assert read == [((r or "").encode(), (x or "").encode()) for r, x in turns]
    assert b"".join(chat_format._TURN.sub(b"", whole).split()) == b""
    for i, (_, text) in enumerate(turns):
        segment = formatted[i].as_py().encode()
        assert chat_format.unescape(segment[start[i]:end[i]]) == (text or "").encode()


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "x" * 9000), (1, 2, None, None), (1, None, "system", "s"),
        (2, 5, "assistant", "<|end|>"), (2, 3, "<|turn|>", "\\<\\|"), (None, 0, "assistant", "é"),
        (3, 0, "assistant", ""), (None, 1, "user", None), (4, 0, "assistant", "a"), (4, 0, "assistant", "a"),
    ]
    turns = spark.createDataFrame(rows, TURNS).repartition(3).selectExpr("*", "'x' AS formatted", "1 AS loss_start")
    found = chat_format.read_conversations(chat_format.format_conversations(turns))
    assert rows_of(found) == brute(rows)
    empty = spark.createDataFrame([], TURNS)
    assert chat_format.read_conversations(chat_format.format_conversations(empty)).collect() == []


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    probe = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    found = QUERIES["op8_chat_format"](spark, sf_dir)
    assert rows_of(found) == brute(rows)
    chars = {r["conv_id"]: r["formatted_chars"] for r in found.collect()}
    assert chars[-7] == sum(len(f"<|turn|>{r}<|text|>{probe}<|end|>") for r in ("user", "assistant"))


def test_long_contents_and_many_short_ones():
    """Both ways of copying, and escaped strings across the pieces that are read at a time."""
    texts = ["<|" * 70_000, "é" * 40_000, "", "x" * 2_000_000 + "<\\\\|", *["<\\|"] * 3000, None, "\\" * 100_000 + "|<" * 9]
    roles = ["assistant"] * len(texts)
    formatted, start, end = chat_format.assemble(pa.array(roles), pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        segment = memoryview(formatted[i].as_py().encode())[start[i]:end[i]]
        assert b"".join(chat_format.unescaped(segment)) == (text or "").encode()


def test_a_turn_of_100_mb_stays_below_500_mb():
    """Measured in a process of its own: text, its escaped form and the output, no index of its bytes."""
    code = """
import resource, sys
sys.path[:0] = %r
import pyarrow as pa
from edgeloom.llm import chat_format
text = pa.array(["<| word " * 12_500_000])
formatted, start, end = chat_format.assemble(pa.array(["assistant"]), text)
del text
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
state = chat_format._Reading()
whole = formatted.cast(pa.large_binary())[0].as_py()
del formatted
state.add(whole, int(start[0]), int(end[0]))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, state.loss_chars)
"""
    done = subprocess.run([sys.executable, "-c", code % sys.path], capture_output=True, text=True, check=True)
    built, read, chars = map(int, done.stdout.split())
    assert chars == 100_000_000 and max(built, read) < 500
