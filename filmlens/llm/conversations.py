"""Conversation repair: the cheapest edits after which the roles follow ``(s?(ua)+)?``.

1. Rows become symbols: role initial (s, u, a, or x for any other) and first
   fault. A conversation is the string of its symbols, its signature; texts stay
   where they are.
2. Signatures of all conversations form one automaton that shares suffixes: a
   node is a suffix, whichever conversations end in it, and has one edge, its
   first symbol, to the next shorter suffix. Different signatures are sorted from
   their ends, so that suffixes in common follow each other; a task then holds
   just the nodes of the current signature and makes each node once.
3. For each node and grammar state (start, after s, after u, after a) the cost to
   go and the first letter of the best audit suffix are computed once, from the
   nodes of the next shorter suffix. From a given state a letter leads to one
   state only, so equal costs are decided by the first letter alone.
4. Audits go back to their conversations, whose rows follow them in order and are
   hashed one by one.

A task streams sorted rows: its memory holds one signature and one audit, of one
byte a row, and one batch of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.sources.staging import materialize

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
"""Costs of the edits, and of a row left in that does not end in ``.``, ``!`` or ``?``."""

START, AFTER_S, AFTER_U, AFTER_A = range(4)
_KEEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
_GIVEN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
"""The state after an inserted or reroled row: its role is the only one of user and assistant that may follow."""
_ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
_FAR = 1 << 60
MUST_DELETE = "d"


def _end() -> tuple[list[int], list[str]]:
    """Costs and first letters of the node of the empty suffix."""
    return _relax([0, _FAR, _FAR, 0], ["", "", "", ""])


def _relax(cost: list[int], letter: list[str]) -> tuple[list[int], list[str]]:
    """With insertions before the node's row: at most two follow each other in a cheapest repair."""
    best = list(cost)
    for _ in range(2):
        best = [min(c, INSERT + best[_GIVEN[q]]) for q, c in enumerate(best)]
    # "D" < "I" < "K" < "R"; the empty audit comes before all.
    letters = [
        min([x for x, c in ((letter[q], cost[q]), ("I", INSERT + best[_GIVEN[q]])) if c == best[q]])
        for q in range(4)
    ]
    return best, letters


def _node(symbol: str, after: list[int]) -> tuple[list[int], list[str]]:
    """Costs and first letters of a node from the costs of the node that its edge leads to."""
    cost, letter = [], []
    initial, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    for q in range(4):
        ways = [(DELETE + after[q], "D")]
        if symbol != MUST_DELETE:
            if (q, initial) in _KEEP:
                ways.append((extra + after[_KEEP[q, initial]], "K"))
            ways.append((REROLE + extra + after[_GIVEN[q]], "R"))
        c, x = min(ways)
        cost.append(c)
        letter.append(x)
    return _relax(cost, letter)


def _audit(signature: str, letters: list[str]) -> str:
    """The best audit: ``letters[4 * k + q]`` is the first letter of the suffix of k symbols in state q."""
    out, q, k = [], START, len(signature)
    while True:
        x = letters[4 * k + q]
        if not x:
            return "".join(out)
        out.append(x)
        if x == "K":
            q = _KEEP[q, signature[len(signature) - k].lower()]
        elif x != "D":
            q = _GIVEN[q]
        k -= x != "I"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs and audits of signatures that come sorted by their reversal."""
    last = ""
    end_cost, end_letter = _end()
    costs, letters = list(end_cost), list(end_letter)
    for batch in batches:
        out_cost, out_audit = [], []
        for backwards in batch.column("backwards").to_pylist():
            shared = 0
            most = min(len(last), len(backwards))
            if last[:most] == backwards[:most]:
                shared = most
            else:
                step = most
                # Halve the part in which the first difference lies.
                while step > 1:
                    half = step // 2
                    if last[shared : shared + half] == backwards[shared : shared + half]:
                        shared += half
                        step -= half
                    else:
                        step = half
            del costs[4 * (shared + 1) :], letters[4 * (shared + 1) :]
            for symbol in backwards[shared:]:
                cost, letter = _node(symbol, costs[-4:])
                costs += cost
                letters += letter
            last = backwards
            out_cost.append(costs[-4 + START])
            out_audit.append(_audit(backwards[::-1], letters))
        yield pa.record_batch(
            [batch.column("signature"), pa.array(out_cost, pa.int64()), pa.array(out_audit, pa.string())], names=["signature", "cost", "audit"]
        )


def solve(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of every different signature."""
    asked = signatures.select("signature").distinct().withColumn("backwards", F.reverse("signature"))
    # Sorted from the end: signatures with a common suffix stand together, in one task but for its edges.
    ordered = asked.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return ordered.mapInArrow(_solve, "signature string, cost bigint, audit string")


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults set by a hash of conversation and turn; nulls become one space."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(blank("conv_id"), F.lit(":"), blank("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = blank("role"), blank("text")
    hit = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("kind"),
    ).filter("kind <> 0")
    return hit.select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")


def _same() -> Column:
    """128 bits that tell rows with different role or text apart."""
    return F.unhex(F.md5(F.concat_ws(":", F.char_length("role").cast("string"), F.col("role"), F.col("text")).cast("binary")))


_ORDER = ["conv_id", "turn", "same"]
_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_LEGAL = {"su", "ua", "au"}


def _signatures(narrow: DataFrame) -> DataFrame:
    """``conv_id, signature`` and the counts of every conversation that has a row.

    ``narrow`` has a row for each turn, role and text of a conversation, with the
    number ``n`` of such rows and whether they are the ``first`` of that role and text.
    """
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    id_type = pa.string() if narrow.schema["conv_id"].dataType.simpleString() == "string" else pa.int64()
    types = [id_type, pa.string(), *[pa.int64()] * 5]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        out: list[tuple] = []

        def close() -> None:
            conv, parts, least, most, turns, blank, duplicate, truncated, illegal, _ = now
            out.append((conv, "".join(parts), most - least + 1 - turns if turns else 0, blank, duplicate, truncated, illegal))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "n", "first")]
            for conv, turn, initial, fault, n, first in zip(*columns, strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, [], None, None, 0, 0, 0, 0, 0, ""]
                if turn is not None and turn != now[3]:
                    now[2] = turn if now[2] is None else now[2]
                    now[3] = turn
                    now[4] += 1
                again = n - (first and fault != "blank")
                if fault == "blank":
                    now[5] += n
                    now[1].append(MUST_DELETE * n)
                else:
                    now[6] += again
                    if first:
                        now[7] += fault == "truncated"
                        now[1].append(initial.upper() if fault == "truncated" else initial)
                    now[1].append(MUST_DELETE * again)
                if now[9]:
                    now[8] += now[9] + initial not in _LEGAL
                now[8] += n - 1
                now[9] = initial
            if len(out) >= 1000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=names)
                out.clear()
        if now is not None:
            close()
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=names)

    kind = narrow.schema["conv_id"].dataType.simpleString()
    return narrow.repartition("conv_id").sortWithinPartitions(*_ORDER).mapInArrow(walk, f"conv_id {kind}, signature string, {_FOUND}")


def _narrow(rows: DataFrame) -> DataFrame:
    """Damaged or given rows without their texts, equal rows of a turn counted."""
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    fault = F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    told = rows.select(
        "conv_id", "turn", _same().alias("same"), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), fault.alias("fault")
    )
    counted = told.groupBy("conv_id", "turn", "same", "initial", "fault").agg(F.count("*").alias("n"))
    # The least turn, a null one before all others, that a conversation has this role and text in.
    at = F.struct("turn")
    firsts = told.groupBy("conv_id", "same").agg(F.min(at).alias("at"))
    known = counted.alias("c").join(
        firsts.alias("f"), F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("c.same") == F.col("f.same"))
    )
    return known.select("c.*", F.col("f.at.turn").eqNullSafe(F.col("c.turn")).alias("first"))


def _repaired(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the conversations in ``solved`` (``conv_id, audit``)."""
    header = solved.select("conv_id", "audit", F.lit(0).alias("part"), *[F.lit(None).cast(t).alias(n) for n, t in
        (("turn", rows.schema["turn"].dataType.simpleString()), ("same", "binary"), ("role", "string"), ("text", "string"))])
    body = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("part"), "turn", _same().alias("same"), "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = audit = digest = None
        at = q = lines = 0
        out: list[tuple] = []

        def put(role: str, text: str) -> None:
            nonlocal lines
            digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            lines += 1

        def inserts() -> None:
            nonlocal at, q
            while at < len(audit) and audit[at] == "I":
                q = _GIVEN[q]
                put(_ROLE[q], "")
                at += 1

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "audit", "role", "text")]
            for c, part, given, role, text in zip(*columns, strict=True):
                if not part:
                    if digest is not None:
                        inserts()
                        out.append((conv, digest.hexdigest()))
                    conv, audit, digest, at, q, lines = c, given, hashlib.sha256(), 0, START, 0
                    continue
                inserts()
                letter = audit[at]
                at += 1
                if letter == "K":
                    q = _KEEP[q, role[:1]]
                    put(role, text)
                elif letter == "R":
                    q = _GIVEN[q]
                    put(_ROLE[q], text)
            if len(out) >= 1000:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), types, strict=True)], names=["conv_id", "repaired_sha256"])
                out.clear()
        if digest is not None:
            inserts()
            out.append((conv, digest.hexdigest()))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), types, strict=True)], names=["conv_id", "repaired_sha256"])

    types = [pa.string() if kind == "string" else pa.int64(), pa.string()]
    both = header.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "same")
    return both.mapInArrow(walk, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest repair and its result of every conversation.

    ``rows`` has ``conv_id`` (bigint or string), ``turn`` (bigint) and, without
    nulls, ``role`` and ``text``; ``conversations`` lists the ``conv_id`` to
    report (default: those of ``rows``). Other columns are not read. Returns
    ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and ``repaired_sha256``.

    Rows of one turn, and of no turn (which come first), are taken in the order
    of a hash of role and text, so equal rows stand together; the second of them
    is a duplicate. A null ``conv_id`` is a conversation. A role with another
    initial, or an empty one, cannot be kept. Empty texts are blank; texts of any
    length are hashed whole. A conversation without rows, like an empty table,
    needs no edit: zeros, an empty audit and the hash of an empty string.
    """
    wanted = (rows if conversations is None else conversations).select("conv_id").distinct()
    found = materialize(_signatures(_narrow(rows)), "signatures")
    solved = materialize(solve(found), "repairs")
    known = found.join(solved, "signature")
    same = F.col("w.conv_id").eqNullSafe(F.col("k.conv_id"))
    zero = lambda name: F.coalesce(F.col(f"k.{name}"), F.lit(0).cast("bigint")).alias(name)
    reported = wanted.alias("w").join(known.alias("k"), same, "left").select(
        "w.conv_id", *[zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("k.audit", F.lit("")).alias("audit"),
    )
    reported = materialize(reported, "repairs-by-conversation")
    hashed = _repaired(rows, reported)
    return reported.alias("r").join(hashed.alias("h"), F.col("r.conv_id").eqNullSafe(F.col("h.conv_id"))).select("r.*", "h.repaired_sha256")


NAME = "op12_conversation_repair"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged by a hash and repaired."""
    given = table(spark, folder, "conversations")
    return repair(damage(given), given)


ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(strlen(k)), lambda i: ('0x' || substr(hex(encode(k)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind
  FROM given, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0
), ordered AS (
  SELECT *, row_number() OVER w AS p, count(*) OVER (PARTITION BY conv_id) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         left(lag(role) OVER w, 1) || left(role, 1) AS pair
  FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text), copy)
), faulty AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS unended, left(role, 1) AS initial
  FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
         count(*) FILTER (unended AND NOT seen AND NOT blank) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), symbols AS (
  SELECT conv_id, p, n, role, text, initial, blank OR seen AS gone, CASE WHEN unended THEN 3 ELSE 0 END AS extra FROM faulty
), back AS (
  -- Cost, audit and repaired lines of the rows from p on, for each grammar state: start, after s, after u, after a.
  SELECT conv_id, n + 1 AS p,
         {'c': 0, 'a': '', 't': []::VARCHAR[]} AS q0, {'c': 6, 'a': 'II', 't': ['user:', 'assistant:']} AS q1,
         {'c': 3, 'a': 'I', 't': ['assistant:']} AS q2, {'c': 0, 'a': '', 't': []::VARCHAR[]} AS q3
  FROM symbols WHERE p = 1
  UNION ALL
  SELECT conv_id, p,
         least(b0, {'c': 3 + i2.c, 'a': 'I' || i2.a, 't': list_prepend('user:', i2.t)}),
         least(b1, {'c': 3 + i2.c, 'a': 'I' || i2.a, 't': list_prepend('user:', i2.t)}), i2,
         least(b3, {'c': 3 + b2.c, 'a': 'I' || b2.a, 't': list_prepend('user:', b2.t)})
  FROM (
    SELECT *, least(b2, {'c': 3 + b3.c, 'a': 'I' || b3.a, 't': list_prepend('assistant:', b3.t)}) AS i2
    FROM (
      SELECT s.conv_id, s.p,
        least({'c': 4 + q0.c, 'a': 'D' || q0.a, 't': q0.t},
              CASE WHEN NOT gone AND initial = 's' THEN {'c': extra + q1.c, 'a': 'K' || q1.a, 't': list_prepend(role || ':' || text, q1.t)} END,
              CASE WHEN NOT gone AND initial = 'u' THEN {'c': extra + q2.c, 'a': 'K' || q2.a, 't': list_prepend(role || ':' || text, q2.t)} END,
              CASE WHEN NOT gone THEN {'c': 3 + extra + q2.c, 'a': 'R' || q2.a, 't': list_prepend('user:' || text, q2.t)} END) AS b0,
        least({'c': 4 + q1.c, 'a': 'D' || q1.a, 't': q1.t},
              CASE WHEN NOT gone AND initial = 'u' THEN {'c': extra + q2.c, 'a': 'K' || q2.a, 't': list_prepend(role || ':' || text, q2.t)} END,
              CASE WHEN NOT gone THEN {'c': 3 + extra + q2.c, 'a': 'R' || q2.a, 't': list_prepend('user:' || text, q2.t)} END) AS b1,
        least({'c': 4 + q2.c, 'a': 'D' || q2.a, 't': q2.t},
              CASE WHEN NOT gone AND initial = 'a' THEN {'c': extra + q3.c, 'a': 'K' || q3.a, 't': list_prepend(role || ':' || text, q3.t)} END,
              CASE WHEN NOT gone THEN {'c': 3 + extra + q3.c, 'a': 'R' || q3.a, 't': list_prepend('assistant:' || text, q3.t)} END) AS b2,
        least({'c': 4 + q3.c, 'a': 'D' || q3.a, 't': q3.t},
              CASE WHEN NOT gone AND initial = 'u' THEN {'c': extra + q2.c, 'a': 'K' || q2.a, 't': list_prepend(role || ':' || text, q2.t)} END,
              CASE WHEN NOT gone THEN {'c': 3 + extra + q2.c, 'a': 'R' || q2.a, 't': list_prepend('user:' || text, q2.t)} END) AS b3
      FROM back JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM back.conv_id AND s.p = back.p - 1
    )
  )
), repaired AS (
  SELECT conv_id, CAST(q0.c AS BIGINT) AS cost, q0.a AS audit, sha256(array_to_string(q0.t, chr(10))) AS repaired_sha256 FROM back WHERE p = 1
)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM given) g
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM g.conv_id
"""
