"""Repair of conversations whose turns are blank, repeated, cut off or out of turn (operator 12).

``faults`` finds what is wrong, ``edits`` the cheapest edits that let roles read ``(s?(ua)+)?`` (module ``auction``),
``repaired`` and ``digests`` apply them.

Turns come in the order of their number (null first), ties by role and then by the MD5 of the text; rows equal in all of
these are one group with a count, so a row that repeats a million times is one row in every shuffle but the last.  A
conversation is not a unit of work either: its groups are dealt by range of (conversation, order), each partition's part
of a conversation (a run) is one string of a byte a turn, runs are solved apart, and a conversation that spans partitions
is put together from one table of 16 costs a run.  Only the audit, one cell by contract, and the texts' hash, which has
to read them in order, hold or pass a whole conversation: as a stream of rows in constant memory beside the audit.

Null role and text are read as one space, a null conv_id or turn in the damage key too.  A role whose first character is
not u, a or s (null and empty ones too) can't be kept.  A null conv_id is a conversation like any other.  A conversation
that lost all rows gets zeros, an empty audit and the hash of nothing; an empty table gives no rows.  Other columns are
never read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm import auction
from ledgerlink.llm.common import bounded_batches, keep, read

SPACES = " \t\n\x0b\x0c\r"
ORDER = ["numbered", "turn", "was_role", "was_text"]
STAY = 1 << 40  # no conversation costs as much


def turns_of(conversations: DataFrame) -> DataFrame:
    """``c`` (a key for conv_id that is never null), the order columns, role and text."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    turn = F.col("turn").cast("long")
    return conversations.select(key.alias("c"), turn.isNotNull().alias("numbered"), F.coalesce(turn, F.lit(0)).alias("turn"), role.alias("was_role"), F.unhex(F.md5(text)).alias("was_text"), role.alias("role"), text.alias("text"), F.lit(1).alias("copies"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns_of`` dropped, emptied, stripped of ``.!?``, doubled or given to the user by a hash of their number."""
    name = F.concat(F.when(F.col("c") == "", " ").otherwise(F.substring("c", 2, 1 << 30)), F.lit(":"), F.when(F.col("numbered"), F.col("turn").cast("string")).otherwise(" "))
    hit = F.crc32(name.cast("binary")) % 20
    out = turns.withColumn("hit", hit).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    return out.withColumns({"text": text, "role": role, "copies": F.when(F.col("hit") == 3, F.col("copies") * 2).otherwise(F.col("copies"))}).drop("hit")


def faults(turns: DataFrame) -> DataFrame:
    """A row for each group of equal turns: ``copies``, ``initial``, and ``kind``: the fault of its first row (``blank``,
    ``duplicate``, ``truncated`` or ``none``).  The further rows of a group that isn't blank are duplicates."""
    end = F.rtrim("text", F.lit(SPACES))
    first = F.substring("role", 1, 1)
    kind = F.when(end == "", "blank").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "none").otherwise("truncated")
    rows = turns.select("c", *ORDER, "copies", "role", F.unhex(F.md5("text")).alias("text"), kind.alias("kind"), F.when(first.isin("u", "a", "s"), first).otherwise("o").alias("initial"))
    # equal in order means equal rows, and so equal damage
    rows = rows.groupBy("c", *ORDER).agg(F.sum("copies").alias("copies"), *(F.first(x).alias(x) for x in ("role", "text", "kind", "initial")))
    seen = rows.where("kind <> 'blank'").groupBy("c", "role", "text").agg(F.min(F.struct(*ORDER)).alias("first"))
    rows = rows.join(seen, ["c", "role", "text"], "left")
    again = (F.col("kind") != "blank") & (F.struct(*ORDER) != F.col("first"))
    return keep(rows.select("c", *ORDER, "copies", "initial", F.when(again, "duplicate").otherwise(F.col("kind")).alias("kind")), "turn-faults")


def counts(found: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated."""
    of = {k: F.sum(F.when(F.col("kind") == k, F.lit(1)).otherwise(0)) for k in ("duplicate", "truncated")}
    blank = F.sum(F.when(F.col("kind") == "blank", F.col("copies")).otherwise(0))
    more = F.sum(F.when(F.col("kind") == "blank", 0).otherwise(F.col("copies") - 1))
    turns = found.where("numbered").groupBy("c", "turn").agg(F.lit(1).alias("one")).groupBy("c").agg((F.max("turn") - F.min("turn") + 1 - F.count("one")).alias("gaps"))
    sums = found.groupBy("c").agg(blank.alias("blank"), (of["duplicate"] + more).alias("duplicate"), of["truncated"].alias("truncated"))
    return sums.join(turns, "c", "left").fillna(0, ["gaps"])


_RUN = "c string, numbered boolean, turn long, was_role string, was_text binary, turns string, initials string, repeats long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of one conversation as one string; rows come in order."""
    names = ["c", *ORDER, "turns", "initials", "repeats"]
    held: list = []

    def out(runs: list[list]) -> pa.RecordBatch:
        runs = [[*r[:5], "".join(r[5]), "".join(r[6]), r[7]] for r in runs]
        kinds = [pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in runs], k) for i, k in enumerate(kinds)], names=names)

    for batch in batches:
        done = []
        for row in zip(*(batch.column(x).to_pylist() for x in ("c", *ORDER, "copies", "initial", "kind")), strict=True):
            *start, copies, initial, kind = row
            if not held or held[0] != start[0]:
                if held:
                    done.append(held)
                held = [*start, [], [], 0]
            goes = kind in ("blank", "duplicate")
            held[5].append(("x" if goes else initial.upper() if kind == "truncated" else initial) + "x" * (copies - 1))
            held[6].append(initial)
            held[7] += copies - 1
        if done:
            yield out(done)
    if held:
        yield out([held])


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _batches(rows: dict, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[n], k) for n, k in zip(names, kinds, strict=True)], names=names)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [auction.cheapest(x) for x in b.column("turns").to_pylist()]
        wrong = [illegal_pairs(x) + k for x, k in zip(b.column("initials").to_pylist(), b.column("repeats").to_pylist(), strict=True)]
        yield _batches({"c": b.column("c"), "cost": [x[0] for x in got], "audit": [x[1] for x in got], "illegal": wrong}, ["c", "cost", "audit", "illegal"], [pa.string(), pa.int64(), pa.string(), pa.int64()])


def _tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A run's costs and label places for each (state before, state after), 16 numbers each (STAY: no way)."""
    for b in batches:
        costs, places = [], []
        for turns in b.column("turns").to_pylist():
            x = auction.block(turns)
            rank = x.ranks()
            costs.append([x.table[s, t][0] if (s, t) in x.table else STAY for s in auction.STATES for t in auction.STATES])
            places.append([rank.get((s, t), 0) for s in auction.STATES for t in auction.STATES])
        initials = b.column("initials").to_pylist()
        wrong = [illegal_pairs(x) + k for x, k in zip(initials, b.column("repeats").to_pylist(), strict=True)]
        extra = {"costs": pa.array(costs, pa.list_(pa.int64())), "places": pa.array(places, pa.list_(pa.int32())), "illegal": pa.array(wrong, pa.int64()), "ends": pa.array([x[0] + x[-1] for x in initials])}
        yield pa.RecordBatch.from_arrays([*b.columns[:6], *extra.values()], names=[*b.schema.names[:6], *extra])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before and after each run of a conversation; a conversation has one run a partition at most."""
    for b in batches:
        out: dict[str, list] = {x: [] for x in ("c", "cost", "illegal", "befores", "afters", "tail")}
        for c, runs in zip(b.column("c").to_pylist(), b.column("runs").to_pylist(), strict=True):
            parts = []
            for r in runs:  # a stand-in whose labels are the places the run's own labels have
                table = {(k // 4, k % 4): (cost, (place,), []) for k, (cost, place) in enumerate(zip(r["costs"], r["places"], strict=True)) if cost < STAY}
                parts.append(auction.Block(table))
            whole = auction.tree([*parts, last := auction.leaf([], True)])
            states = _states(whole, auction.START, auction.START)
            out["c"].append(c)
            out["cost"].append(whole.table[auction.START, auction.START][0])
            out["illegal"].append(sum(r["illegal"] for r in runs) + sum(illegal_pairs(x["ends"][-1] + y["ends"][0]) for x, y in zip(runs, runs[1:], strict=False)))
            out["befores"].append([auction.START, *states[: len(parts) - 1]])
            out["afters"].append(states[: len(parts)])
            out["tail"].append(last.table[states[len(parts) - 1], auction.START][1])
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
        yield _batches(out, list(out), kinds)


def _states(block: auction.Block, before: int, after: int) -> list[int]:
    """The states after each leaf block on the chosen way."""
    if block.parts is None:
        return [after]
    out = []
    for part, state in zip(block.parts, block.table[before, after][2], strict=True):
        out += _states(part, before, state)
        before = state
    return out


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*(b.column(x).to_pylist() for x in ("turns", "before", "after")), strict=True)
        piece = [auction.block(turns).edits(before, after) for turns, before, after in rows]
        yield _batches({"c": b.column("c"), "place": b.column("place"), "piece": piece}, ["c", "place", "piece"], [pa.string(), pa.int32(), pa.string()])


def edits(found: DataFrame) -> DataFrame:
    """c, cost, audit, illegal for each conversation of ``faults``."""
    bounded_batches(found.sparkSession)
    dealt = found.repartitionByRange("c", *ORDER).sortWithinPartitions("c", *ORDER)
    runs = keep(dealt.mapInArrow(_runs, _RUN), "turn-runs")
    many = runs.groupBy("c").count().where("count > 1").select("c")
    whole = runs.join(many, "c", "left_anti").mapInArrow(_solved, "c string, cost long, audit string, illegal long")
    spread = keep(runs.join(many, "c", "left_semi").mapInArrow(_tabled, "c string, numbered boolean, turn long, was_role string, was_text binary, turns string, costs array<long>, places array<int>, illegal long, ends string"), "turn-tables")
    spread = spread.withColumn("place", F.row_number().over(Window.partitionBy("c").orderBy(*ORDER)) - 1)
    small = F.struct("place", "costs", "places", "illegal", "ends")
    chosen = spread.groupBy("c").agg(F.array_sort(F.collect_list(small)).alias("runs")).mapInArrow(_chosen, "c string, cost long, illegal long, befores array<int>, afters array<int>, tail string")
    chosen = keep(chosen, "turn-ways")
    ways = chosen.select("c", F.posexplode(F.arrays_zip("befores", "afters")).alias("place", "way")).select("c", "place", F.col("way.befores").alias("before"), F.col("way.afters").alias("after"))
    pieces = spread.select("c", "place", "turns").join(ways, ["c", "place"]).mapInArrow(_traced, "c string, place int, piece string")
    audits = pieces.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("x"))
    audits = chosen.join(audits, "c").select("c", "cost", F.concat(F.array_join("x.piece", ""), F.col("tail")).alias("audit"), "illegal")
    return keep(whole.unionByName(audits), "turn-edits")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str, str]]:
    """(c, edit, role, text) of each turn that stays or is inserted, and (c, '', '', '') where a conversation begins.
    A conversation's first row is its audit; its turns follow in order."""
    c, audit, at, state = None, "", 0, auction.START

    def given() -> str:
        return "assistant" if state == auction.AFTER_U else "user"

    def after(initial: str) -> int:
        return {"s": auction.AFTER_S, "u": auction.AFTER_U, "a": auction.AFTER_A}[initial]

    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("c", "audit", "role", "text", "copies")), strict=True):
            if row[1] is not None:
                while at < len(audit):
                    yield c, "I", given(), ""
                    at, state = at + 1, after(given()[0])
                c, audit, at, state = row[0], row[1], 0, auction.START
                yield c, "", "", ""
                continue
            for _ in range(row[4]):
                while audit[at] == "I":
                    yield c, "I", given(), ""
                    at, state = at + 1, after(given()[0])
                edit = audit[at]
                at += 1
                if edit != "D":
                    role = row[2] if edit == "K" else given()
                    yield c, edit, role, row[3]
                    state = after(role[0])
    while at < len(audit):
        yield c, "I", given(), ""
        at, state = at + 1, after(given()[0])


def _applied(turns: DataFrame, solved: DataFrame, run: Callable, schema: str) -> DataFrame:
    """One shuffle: audits and turns of a conversation come to one task, in order, as a stream."""
    head = solved.select("c", F.lit(0).alias("kind"), F.lit(False).alias("numbered"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("was_role"), F.unhex(F.lit("")).alias("was_text"), "audit", F.lit("").alias("role"), F.lit("").alias("text"), F.lit(1).alias("copies"))
    body = turns.select("c", F.lit(1).alias("kind"), *ORDER, F.lit(None).cast("string").alias("audit"), "role", "text", "copies")
    both = head.unionByName(body).repartition("c").sortWithinPartitions("c", "kind", *ORDER)
    return both.select("c", "audit", "role", "text", "copies").mapInArrow(run, schema)


def repaired(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired turns: c, place (from 0), edit (K, R or I), role, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["c", "place", "edit", "role", "text"], [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        rows: list[tuple] = []
        size, place = 0, 0
        for c, edit, role, text in _walk(batches):
            if not edit:
                place = 0
                continue
            rows.append((c, place, edit, role, text))
            place, size = place + 1, size + len(text)
            if len(rows) >= 4096 or size > 1 << 22:
                yield _batches(dict(zip(names, zip(*rows, strict=True), strict=True)), names, kinds)
                rows, size = [], 0
        if rows:
            yield _batches(dict(zip(names, zip(*rows, strict=True), strict=True)), names, kinds)

    return _applied(turns, solved, run, "c string, place long, edit string, role string, text string")


def digests(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """c and the SHA-256 of its repaired ``role:text`` lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, str]] = []
        c, sha, first = None, hashlib.sha256(), True

        def out(rows: list) -> pa.RecordBatch:
            return _batches({"c": [x[0] for x in rows], "sha": [x[1] for x in rows]}, ["c", "sha"], [pa.string(), pa.string()])

        for key, edit, role, text in _walk(batches):
            if not edit:
                if c is not None:
                    done.append((c, sha.hexdigest()))
                if len(done) >= 4096:
                    yield out(done)
                    done = []
                c, sha, first = key, hashlib.sha256(), True
                continue
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if c is not None:
            yield out([*done, (c, sha.hexdigest())])

    return _applied(turns, solved, run, "c string, sha string")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    turns = damaged(turns_of(conversations))
    found = faults(turns)
    solved = edits(found)
    every = turns_of(conversations).select("c").distinct()
    out = every.join(counts(found), "c", "left").join(solved, "c", "left").join(digests(turns, solved), "c", "left")
    kind = conversations.schema["conv_id"].dataType
    nothing = hashlib.sha256().hexdigest()
    numbers = [F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    conv_id = F.when(F.col("c") != "", F.substring("c", 2, 1 << 30)).cast(kind).alias("conv_id")
    return out.select(conv_id, *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))
