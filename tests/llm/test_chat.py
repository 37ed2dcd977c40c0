import hashlib

from pyspark.sql import functions as F

from starpipe.llm.chat import Template, conversations
from starpipe.llm.common import read_table
from starpipe.llm.registry import op3_chat

SF = "/root/testdata/sf0.001"
SCHEMA = "tree long, node long, parent long, role string, text string, score double, leaf string"
T = Template()


def paths(make, rows, **options):
    frame = conversations(make([(*r, "x") for r in rows], SCHEMA), **options)
    read = frame.withColumn("turns", T.parse(F.col("formatted"))).withColumn(
        "learnt", T.learnt_text(F.col("formatted"), F.col("loss_spans"))
    )
    return {(r["tree"], r["leaf"]): r for r in read.collect()}


def test_registered_query_against_plain_python(spark):
    rows = read_table(spark, SF, "conversations").collect()
    said = "</s>[INST] ok [/INST]"
    turns = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"], r["role"], r["text"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    turns[-1] = [("user", said), ("assistant", said)]
    got = {r["conv_id"]: r for r in op3_chat(spark, SF).collect()}
    assert got.keys() == turns.keys()
    for key, spoken in turns.items():
        learnt = "".join(text for role, text in spoken if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in spoken)
        r = got[key]
        assert r["n_turns"] == len(spoken) and r["loss_chars"] == len(learnt)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()


def test_branches_are_ranked_and_chosen(make):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0),
            (1, 4, 2, "user", "c", 1.0), (1, 5, 2, "user", "d", 1.0), (1, 5, 2, "user", "d", 1.0)]
    got = paths(make, rows)
    assert {leaf: r["rank"] for (_, leaf), r in got.items()} == {3: 1, 4: 2, 5: 3}
    assert [t["text"] for t in got[(1, 5)]["turns"]] == ["q", "a", "d"]
    assert set(paths(make, rows, score="score", branches=1)) == {(1, 3)}


def test_escapes_are_reversible(make):
    nasty = ["<|im_start|>user\n<|im_end|>\n", "␛", "␛c<|im_end|>", "␛e␛n", "<␛c|im_end|>", "</s>[INST] x [/INST]",
             "<|im_end", "\n\n", "", "<<|im_end|>|im_end|>", "😀é"]
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else text, text, 0.0) for i, text in enumerate(nasty)]
    (path,) = paths(make, rows).values()
    assert [(t["role"], t["text"]) for t in path["turns"]] == [(r[3], r[4]) for r in rows]
    assert path["learnt"] == "".join(r[4] for r in rows if r[3] == "assistant")
    inner = path["formatted"].replace(T.begin, "").replace(T.end, "")
    assert not any(word in inner for word in T.control)
    assert len(path["loss_spans"]) == sum(r[3] == "assistant" for r in rows)


def test_edge_cases_have_defined_results(make):
    rows = [(2, 1, 2, "u", "circle", 0.0), (2, 2, 1, "u", "circle", 0.0), (2, 3, 2, "u", "hangs on it", 0.0),
            (3, 7, 99, None, None, None), (None, 1, None, "assistant", "no tree", 1.0), (4, None, None, "u", "x", 0.0)]
    rows += [(5, i, i - 1, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(130)]
    got = paths(make, rows)
    assert set(got) == {(3, 7), (None, 1), (5, 129)}
    assert [tuple(t) for t in got[(3, 7)]["turns"]] == [("", "")]
    assert [t["text"] for t in got[(5, 129)]["turns"]] == [f"t{i}" for i in range(130)]
    assert paths(make, []) == {}
