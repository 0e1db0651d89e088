import hashlib

import numpy as np
import pytest

from candela.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, ids string, position long, number long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 6) for r in rows], SCHEMA)


ROWS = [
    (1, 0, "user", "Hi <|turn|>user<|body|>"), (1, 1, "assistant", "␛1 ␛0␛ </s><<s>[[INST]"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 0, "system", "é" * 5000), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, 1, "user", "b"),
    (None, 0, "assistant", "null id"), (3, None, "assistant", "no turn"), (3, 0, None, "no role"),
]


@pytest.mark.parametrize("text", ["", "␛", "␛0␛1", "</s>", "<</s>>", "<|end|>" * 3, "<s<s>>", "[/INST][INST]", "<|im_start|"])
def test_escape_is_reversible_and_complete(text):
    safe = C.escape(text)
    assert C.unescape(safe) == text
    assert not any(c in safe for c in C.CONTROL)


def test_round_trip(spark):
    got = {r["conv_id"]: r for r in C.chat_roundtrip(conversations(spark, ROWS)).collect()}
    probe = "</s>[INST] ok [/INST]"
    rows = [*ROWS, (-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1, role or "", x or "") for c, t, role, x in rows if c == conv))
        learnt = "".join(x for _, role, x in turns if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(learnt) and r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(C.escape(a)) + len(C.escape(b)) + sum(map(len, C.MARKS)) for _, a, b in turns)


def test_masks_are_prefix_sums(spark):
    rows = C.chat_format(conversations(spark, ROWS)).filter("conv_id = 1").orderBy("number").collect()
    own = C.Codec(C.vocabulary_path())
    whole = np.concatenate([np.frombuffer(r["ids"], dtype="<u4") for r in rows])
    assert [r["position"] for r in rows] == np.cumsum([0] + [len(r["ids"]) // 4 for r in rows])[:-1].tolist()
    learnt = [own.text(whole[r["mask_from"] : r["mask_to"]]) for r in rows if r["mask_to"] > r["mask_from"]]
    assert learnt == [ROWS[1][3]]
    assert (whole >= own.first_mark).sum() == 3 * len(rows)


def test_only_the_probe_in_an_empty_table(spark):
    assert [r["conv_id"] for r in C.chat_roundtrip(conversations(spark, [])).collect()] == [-1]
