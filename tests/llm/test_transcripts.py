from itertools import product

import numpy as np
import pytest

from postweave.llm import transcripts as tr


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    chances = tr.Chances(rng.random(tr.STATES) * 9, rng.random((tr.STATES, tr.STATES)) * 9, [rng.random((tr.STATES, n)) * 9 for n in tr.FEATURES.values()])
    features = np.stack([rng.integers(0, n, 5) for n in tr.FEATURES.values()], axis=1)

    def score(path):
        total = chances.first[path[0]] + sum(chances.steps[a, b] for a, b in zip(path, path[1:]))
        return total + sum(e[s, f] for s, row in zip(path, features) for e, f in zip(chances.emitted, row))

    best = max(product(range(tr.STATES), repeat=5), key=score)
    assert score(chances.best_path(features)) == pytest.approx(score(best))


@pytest.mark.parametrize(
    "line, kind, rest",
    [
        ("User: hi", 1, "hi"),
        ("[AI] hello", 2, "hello"),
        ("### Answer: yes", 2, "yes"),
        ("**Q**: why", 1, "why"),
        ("<|system|> be kind", 0, "be kind"),
        ("bot> ok", 2, "ok"),
        ("Note: this", 3, "Note: this"),
        ("plain words", 4, "plain words"),
        ("", 4, ""),
    ],
)
def test_markers(line, kind, rest):
    assert tr.marker_of(line) == (kind, rest)


def test_roles_of_held_out_conversations(conversations):
    rows = tr.role_report(conversations).collect()
    assert sum(r.n_turns for r in rows) == conversations.distinct().count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lines_right for r in held) / sum(r.n_lines for r in held) > 0.95
    exact = [r for r in rows if r.n_turns == r.turns_found]
    assert len(exact) > 0.7 * len(rows)
    for r in exact[:200]:
        assert len(tr.read_rendered(r.rendered)) == r.n_turns


def test_turns_come_back(conversations):
    chances = tr.fit(tr.written_down(conversations))
    text = "System: be brief\n\nUser: what is it?\nand why?\n\nAssistant: a thing.\n<|end|> is no tag here"
    turns, roles = tr.turns_of(text, chances)
    assert turns == [("system", "be brief"), ("user", "what is it?\nand why?"), ("assistant", "a thing.\n<|end|> is no tag here")]
    assert roles == ["system", "user", "user", "assistant", "assistant"]
    assert tr.read_rendered(tr.rendered(turns)) == turns


def test_counts_do_not_depend_on_partitions(conversations):
    once, again = (tr.fit(tr.written_down(conversations.repartition(n))) for n in (1, 7))
    assert np.allclose(once.first, again.first) and np.array_equal(once.steps, again.steps)


def test_long_conversations_make_several_transcripts(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"line {k}") for k in range(300)] + [(1, 0, "user", f"other {k}") for k in range(200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = tr.written_down(frame, turns=64).collect()
    assert max(len(r.begins) for r in found) <= 64 and sum(len(r.roles) for r in found) == 500
    assert len({r.part for r in found}) == len(found) > 7
    assert sum(bool(line.strip()) for r in found for line in r.text.split("\n")) == 500


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 1, "tool", "x\r\ny\r\n\r\n z"), (2, None, "system", "\n \n"), (3, 0, "user", "a " * 500_000)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    found = tr.role_report(frame).collect()
    assert sum(r.n_turns for r in found) == 5 and {r.conv_id for r in found} == {None, 1, 2, 3}
    assert tr.role_report(frame.limit(0)).collect() == []
    chances = tr.fit(tr.written_down(frame))
    parsed = tr.parse_transcripts(spark.createDataFrame([(None, 1), ("", 2), ("hi", 3)], "text string, turns int"), chances).collect()
    assert [len(r.turns) for r in parsed] == [0, 0, 1]


@pytest.mark.parametrize("text", ["a <\\| b", "a <| b", "\\", "\\\\|", "<|end|>\n<|user|>", "x\\\ny", "", "<\\\\|"])
def test_rendering_is_undone(text):
    turns = [("user", text), ("assistant", text + " b")]
    assert tr.read_rendered(tr.rendered(turns)) == turns
