import hashlib
import random

from indicatrix.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
HOSTILE = "</s>[INST] ok [/INST]"


def rows(seed=1):
    rng = random.Random(seed)
    pieces = ["<|im_end|>\n", "<|im_next|>", "\\", "\\l", "\\e", "<", "|", "[INST]", "\n", "é\U0001f600", "text", "", "<|im_start|>user<|im_sep|>"]
    out = []
    for c in range(40):
        for t in range(rng.randint(1, 7)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
            out.append((c, t, rng.choice(["user", "assistant", "assistant", "system", None, "a<|b\\"]), text, "x"))
    out += [(None, 1, "user", "no id", "x"), (50, 0, "assistant", "", "x"), (51, 0, "user", "x" * 200_000 + "<", "x"), (52, None, "user", "n", "x"), (52, 0, "user", "m", "x")]
    out += [(53, 0, "assistant", "same", "x")] * 2
    rng.shuffle(out)
    return out


def test_round_trip(spark):
    data = rows()
    got = {r["conv_id"]: r for r in chat.digest(spark.createDataFrame(data, SCHEMA)).collect()}
    convs = {-1: [(0, "user", HOSTILE), (1, "assistant", HOSTILE)]}
    for c, t, role, text, _ in data:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = sorted(turns)
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_template(spark):
    out = chat.formatted(spark.createDataFrame([(1, 0, "user", "a", ""), (1, 1, "user", "<b", ""), (1, 2, "assistant", "c", "")], SCHEMA)).first()
    assert out["formatted"] == "<|im_start|>user<|im_sep|>a<|im_next|>\\lb<|im_end|>\n<|im_start|>assistant<|im_sep|>c<|im_end|>\n"
    assert [out["formatted"][m["start"] : m["start"] + m["length"]] for m in out["loss_mask"]] == ["c"]


def test_empty_table(spark):
    assert [r["conv_id"] for r in chat.digest(spark.createDataFrame([], SCHEMA)).collect()] == [-1]
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
