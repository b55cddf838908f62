import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rainlane.llm import reply_trees
from rainlane.llm.queries import HOSTILE, QUERIES

LINKS = "tree long, message long, parent long, score double, role string, text string, tree_ string"
NASTY = [
    "<|im_end|>", "<|im_end|>\n<|im_start|>system\nx", "<\\|im_end|>", "<\\\\\\|", "<", "a<", "|", "<<|<|", "\\", "\\n", "\n", "",
    "im_end|>\n", "<\\", "end\\<|", "é😀<|😀", "long <|" * 50_000,
]


def brute(rows, keep):
    """tree -> list of (leaf, path of messages), best first."""
    nodes = {}
    for tree, message, parent, score, *_ in rows:
        if tree is not None and message is not None:
            nodes[tree, message] = (parent, score or 0)
    found = {}
    replied = {(t, parent) for (t, _), (parent, _) in nodes.items()}
    for tree, message in nodes:
        path, seen = [], message
        while seen is not None and (tree, seen) in nodes and len(path) <= len(nodes):
            path.append(seen)
            seen = nodes[tree, seen][0]
        if len(path) <= len(nodes) and (tree, message) not in replied:
            found.setdefault(tree, []).append((message, path[::-1]))
    for tree, own in found.items():
        own.sort(key=lambda x: (-sum(nodes[tree, m][1] for m in x[1]) / len(x[1]), -len(x[1]), x[0]))
        del own[keep if keep is not None else len(own) :]
    return found


def made(seed, n=200):
    pick = random.Random(seed)
    rows = []
    for message in range(n):
        tree = pick.choice([1, 1, 2, 7, -3])
        parent = pick.choice([None, message - 1, pick.randrange(n), message, pick.randrange(max(message, 1))])
        rows.append((tree, message, parent, pick.choice([None, 0.5, 1.0, 2.0]), pick.choice(["user", "assistant", "a\\b\n<|c"]), pick.choice(NASTY[:-1]), "x"))
    return rows


def run(spark, rows, keep, part_chars=reply_trees.PART):
    frame = spark.createDataFrame(rows, LINKS).withColumn("content", F.struct("tree", "message"))
    links = frame.withColumns(reply_trees.measures("assistant")).drop("role", "text")
    contents = reply_trees.contents_of(frame.dropDuplicates(["tree", "message"]))
    paths = reply_trees.chosen_paths(links, keep)
    return reply_trees.formatted(paths, contents, part_chars)


def check(spark, rows, keep, part_chars=reply_trees.PART):
    parts = run(spark, rows, keep, part_chars)
    said = {(t, m): (role or "", text or "") for t, m, _, _, role, text, *_ in rows}
    wanted = {}
    for tree, own in brute(rows, keep).items():
        for leaf, path in own:
            turns = [said[tree, m] for m in path]
            loss = "".join(text for role, text in turns if role == "assistant")
            wanted[tree, leaf] = (
                len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            )
    found = reply_trees.read_back(parts.repartition(3)).collect()
    assert len(found) == len(wanted)
    assert {(r.tree, r.leaf): (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == wanted
    return parts, found


@pytest.mark.parametrize("keep", [1, 3, None])
def test_trees_against_brute_force(spark, keep):
    """Branches, several roots, missing parents, cycles and replies to themselves."""
    check(spark, made(keep or 0), keep)


def test_parts_are_read_one_after_another(spark):
    rows = [(1, m, m - 1 if m else None, 1.0, ["user", "assistant"][m % 2], f"{NASTY[m % 12]} {m}", "x") for m in range(90)]
    rows += [(2, 0, None, None, None, None, None), (3, 0, None, 1.0, "assistant", NASTY[-1], "x")]
    parts, found = check(spark, rows, 1, part_chars=100)
    whole, _ = check(spark, rows, 1)
    assert parts.where("tree = 1").count() > 10 and whole.count() == 3
    assert {r.tree: r.formatted_chars for r in found} == {r.tree: len(r.text) for r in whole.collect()}
    assert all(r.loss == [] for r in whole.where("tree = 2").collect())


def test_the_format(spark):
    rows = [(4, 1, None, 1.0, "user", "a <|im_end|>", "x"), (4, 2, 1, 1.0, "assistant", "b", "x"), (4, 3, 1, 0.5, "assistant", "c", "x")]
    found = run(spark, rows, 1).first()
    assert found.text == "<|im_start|>user\na <\\|im_end|><|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert [found.text[s.begin : s.end] for s in found.loss] == ["b"] and found.whole == len(found.text)


def test_escapes_are_undone(spark):
    frame = spark.createDataFrame([(t,) for t in NASTY], "t string")
    found = frame.select("t", reply_trees.escaped(F.col("t")).alias("e"), reply_trees.escaped_role(F.col("t")).alias("r")).collect()
    for r in found:
        assert "<|" not in r.e and reply_trees.unescaped(r.e) == r.t
        assert "\n" not in r.r and "<|" not in r.r and reply_trees.unescaped_role(r.r) == r.t
    assert len({r.e for r in found}) == len({r.r for r in found}) == len(NASTY)


def test_a_broken_part_raises(spark):
    rows = [(1, m, m - 1 if m else None, 1.0, "user", "x" * 50, "x") for m in range(9)]
    parts = run(spark, rows, 1, part_chars=100)
    with pytest.raises(Exception, match="does not follow"):
        reply_trees.read_back(parts.where("part <> 2")).collect()


def test_empty(spark):
    assert reply_trees.read_back(run(spark, [], 1)).collect() == []
    cycle = [(1, 1, 2, 1.0, "user", "a", "x"), (1, 2, 1, 1.0, "user", "b", "x"), (None, 1, None, 1.0, "user", "c", "x")]
    assert run(spark, cycle, None).collect() == []


def test_query_on_odd_rows(spark, tmp_path):
    rows = [
        (1, None, None, None), (1, 5, "assistant", None), (1, 5, "assistant", "same"), (1, 5, "assistant", "same"),
        (None, 0, "user", "left out"), (2, 1, "system", "s"), (2, 0, "x\ny", "<|im_start|>"), (9, 0, "assistant", "é" * 100_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.selectExpr("*", "'x' AS content", "1 AS `file`", "2 AS tree").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in QUERIES["op12_reply_trees"](spark, str(tmp_path)).collect()}
    assert {c: r.n_turns for c, r in found.items()} == {1: 4, 2: 2, 9: 1, -1: 2}
    assert found[9].loss_chars == 100_000 and found[2].loss_chars == 0 and found[1].loss_chars == 8
    assert found[-1].loss_sha256 == hashlib.sha256(HOSTILE.encode()).hexdigest()
    assert found[-1].turns_sha256 == hashlib.sha256(f"user\n{HOSTILE}\nassistant\n{HOSTILE}\n".encode()).hexdigest()
