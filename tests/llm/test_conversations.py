import hashlib
import itertools
import re
import zlib

import pytest

from filmlens.llm.conversations import _solve, damage, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows, longest=4):
    """Cheapest repair by trying every sequence of edits with up to ``longest`` insertions."""
    seen, symbols = set(), []
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        symbols.append(fault)
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for added in range(longest + 1):
            for where in itertools.combinations_with_replacement(range(len(rows) + 1), added):
                audit, lines, cost, legal = "", [], 3 * added, True
                for i in range(len(rows) + 1):
                    audit += "I" * where.count(i)
                    lines += [(None, "")] * where.count(i)
                    if i == len(rows):
                        break
                    audit += edits[i]
                    if edits[i] == "D":
                        cost += 4
                        continue
                    legal &= symbols[i] in ("", "truncated")
                    cost += 3 * (symbols[i] == "truncated") + 3 * (edits[i] == "R")
                    lines.append((rows[i][0] if edits[i] == "K" else None, rows[i][1]))
                if not legal or (best and (cost, audit) >= best[:2]):
                    continue
                # Roles that may be chosen are settled by their place.
                for odd in (0, 1):
                    chosen = [r if r is not None else ("user", "assistant")[(i + odd) % 2] for i, (r, _) in enumerate(lines)]
                    if GRAMMAR.fullmatch("".join(r[:1] or "?" for r in chosen)):
                        text = "\n".join(f"{r}:{t}" for r, (_, t) in zip(chosen, lines, strict=True))
                        best = (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return best


CASES = {
    1: [("system", "Be kind."), ("user", "Hi."), ("assistant", "Hello.")],
    2: [("user", "Hi."), ("user", "Hi."), ("assistant", "no end")],
    3: [("assistant", "First."), ("tool", "x."), ("user", " ")],
    4: [("system", "a."), ("system", "b."), ("assistant", "c.")],
    5: [("user", "a."), ("assistant", "b."), ("user", "c."), ("assistant", "b.")],
    6: [("", "empty role."), ("assistant", "b!"), ("user", "c?"), ("user", "d")],
    7: [("user", ""), ("assistant", "\t\n")],
    8: [("assistant", "x"), ("assistant", "y"), ("assistant", "z")],
}


def test_every_sequence_of_edits(spark):
    rows = [(c, t, role, text) for c, said in CASES.items() for t, (role, text) in enumerate(said)]
    got = {r.conv_id: r for r in repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    for c, said in CASES.items():
        assert (got[c].cost, got[c].audit, got[c].repaired_sha256) == brute(said), c
    assert (got[2].duplicate, got[2].truncated, got[7].blank, got[1].illegal, got[4].illegal) == (1, 1, 2, 0, 2)


def test_nulls_ties_and_clashes(spark):
    rows = [(None, None, "user", "Hi.", 1), (None, 3, "assistant", "Yes.", 2), (None, 3, "assistant", "Yes.", 3), (None, 7, "user", "Hi.", 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", audit int").withColumnRenamed("audit", "signature")
    (only,) = repair(df).collect()
    assert (only.conv_id, only.gaps, only.duplicate, only.illegal, only.cost, only.audit) == (None, 3, 2, 1, 8, "KKDD")
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(empty).collect() == []
    (none,) = repair(empty, spark.createDataFrame([(5,)], "conv_id bigint")).collect()
    assert tuple(none) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation_in_one_row_a_turn(spark):
    n = 30_000
    df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('text ', id, '.') AS text")
    (only,) = repair(df).collect()
    assert (only.cost, only.audit, only.gaps) == (0, "K" * n, 0)


def test_damage_by_hash(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(10) for t in range(10)] + [(None, None, None, None)]
    got = sorted(tuple(str(v) for v in r) for r in damage(spark.createDataFrame(rows, SCHEMA)).collect())
    want = []
    for c, t, role, text in rows:
        c, t, role, text = (" " if v is None else v for v in (c, t, role, text))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = {1: "", 2: text.replace(".", "").replace("!", "")}.get(kind, text)
        row = tuple("None" if v == " " and i < 2 else str(v) for i, v in enumerate((c, t, "user" if kind == 4 else role, text)))
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want)


@pytest.mark.parametrize("size", [1, 3, 100])
def test_nodes_are_shared_whatever_the_batches(size):
    import pyarrow as pa

    words = sorted("".join(w) for n in range(5) for w in itertools.product("suaAd", repeat=n))
    whole = [pa.record_batch({"signature": [w[::-1] for w in words], "backwards": words})]
    parts = [whole[0].slice(i, size) for i in range(0, len(words), size)]
    alone = [next(_solve([whole[0].slice(i, 1)])).to_pylist()[0] for i in range(len(words))]
    assert [r for b in _solve(iter(parts)) for r in b.to_pylist()] == alone
