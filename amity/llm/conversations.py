"""Conversation structure repair: a suffix-shared automaton of role/fault signatures.

*Signatures.* Each row of a conversation becomes one symbol: its role's initial
and its first fault (blank, duplicate, truncated or none). Faults need no
texts side by side: a duplicate is a row whose role and text (two independent
64-bit hashes) have an earlier row in the conversation. Equal rows are folded
map-side, the folded rows are put into one global order by range, and
signatures are joined from pieces of at most ``PIECE`` rows; so a conversation
with a third of all rows is spread over tasks like any other rows, and what is
gathered for it is one character a row, as long as the audit it must return.

*Automaton.* The different signatures are read in the order of their reversed
text. Each shares the longest possible suffix with the one before it; nodes of
that suffix stay, so every node (a suffix of any conversation) is made once. It
holds, for each state of the grammar ``(s?(ua)+)?``, the cost to go and the
first letter of the best audit suffix; the suffix itself is the letters along
the shared path. Nodes with the same costs but for a constant share one shape,
and there are few shapes. Of equal costs the ASCII-least letter wins: in one
node and state no two choices begin with the same letter, so that settles
ties between whole audits.

*Repair.* A conversation's audit travels as a row that sorts before its
others; one pass over the sorted rows applies it, a row at a time, whatever a
conversation's length. (SHA-256 of a conversation can only be computed in
order, so this last pass has one task a conversation, but no memory grows.)

Edits: Keep 0, Rerole to user or assistant 2, Delete 3, Insert an empty user
or assistant row 2; a truncated row that is not deleted adds 1; blank and
duplicate rows must be deleted.

Defined results: a NULL role or text is one space, in the hash that damages
rows a NULL conv_id or turn is one space too; rows without conv_id are one
conversation, which comes back with NULL; rows stand in the order of turn
(NULL first), then role, then the two hashes of role and text, so rows of one
turn have a fixed order and equal ones are neighbours; gaps that exceed a
bigint are NULL; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os.path
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table, written

PIECE = 4096              # rows of a signature put in order at once
HOLD_CHARS = 4 << 20      # of audits or texts handed on at once
SPACE = " \t\n\x0b\f\r"   # what a blank row is made of
ENDS = (".", "!", "?")    # of a row that is not truncated
NAMES = {"u": "user", "a": "assistant"}
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
# states of the grammar: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
NEXT_ROLE, NEXT_STATE, DONE = "uuau", (2, 2, 3, 2), (0, 3)
LEGAL = ("su", "ua", "au")
FAR = 1 << 40             # more than any finite difference of costs
PLAN_DDL = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
PLAN = [f.split()[0] for f in PLAN_DDL.split(", ")]


# ------------------------------------------------------------------- rows

def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text)`` with one space for a NULL role or text."""
    def value(name: str) -> Column:
        return F.coalesce(F.col(col_ref(name)).cast("string"), F.lit(" "))

    return conversations.select(F.col(col_ref(conv_id)).cast("bigint").alias("conv_id"), F.col(col_ref(turn)).cast("bigint").alias("turn"),
                                value(role).alias("role"), value(text).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """``turns`` rows with the faults that a checksum of their place deals out:
    a twentieth each is dropped, emptied, robbed of its sentence ends, repeated
    or given to the user."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = (F.crc32(place.cast("binary")) % 20).cast("int").alias("kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return (rows.select("*", kind).where("kind != 0").withColumn("copy", F.explode(copies))
            .select("conv_id", "turn", role.alias("role"), text.alias("text")))


def _hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2")]


ORDER = ("conv_id", "turn", "role", "h1", "h2")  # ascending, NULL first


def signatures(rows: DataFrame) -> DataFrame:
    """``(conv_id, signature, gaps, blank, duplicate, truncated)`` of every
    conversation that has rows. A symbol is the initial s, u, a, or o for any
    other; in upper case for a truncated row, as 1, 2, 3 or 4 for one that must
    be deleted."""
    initial = F.substring("role", 1, 1)
    role_class = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    faults = [(bare == "").alias("is_blank"), (~F.substring(bare, -1, 1).isin(*ENDS)).alias("is_cut")]
    folded = (rows.select("conv_id", "turn", "role", *_hashes(), role_class.alias("class"), *faults)
              .groupBy(*ORDER, "class", "is_blank", "is_cut").agg(F.count(F.lit(1)).alias("copies")))
    placed = written(folded.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
                     .withColumn("pos", F.monotonically_increasing_id()).drop("role"), "conv-rows")
    # of the rows with one role and text in a conversation, the first is none of the duplicates
    first = placed.groupBy("conv_id", "h1", "h2").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    marked = placed.join(first, "pos", "left").withColumn("again", F.col("is_first").isNull())
    gone = F.translate("class", "suao", "1234")
    symbol = F.when(F.col("is_blank") | F.col("again"), gone).when(F.col("is_cut"), F.upper("class")).otherwise(F.col("class"))
    run = F.concat(symbol, F.repeat(gone, (F.col("copies") - 1).cast("int")))
    block = F.shiftright("pos", PIECE.bit_length() - 1).alias("block")
    later = F.col("copies") - F.when(F.col("again"), 0).otherwise(1)
    pieces = marked.groupBy("conv_id", block).agg(
        F.array_sort(F.collect_list(F.struct("pos", run.alias("run")))).alias("runs"),
        F.sum(F.when(F.col("is_blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("is_blank"), 0).otherwise(later)).alias("duplicate"),
        F.sum((~F.col("is_blank") & ~F.col("again") & F.col("is_cut")).cast("int")).alias("truncated"))
    none = F.lit(None)
    pieces = pieces.select("conv_id", F.struct("block", F.array_join("runs.run", "").alias("piece")).alias("piece"),
                           "blank", "duplicate", "truncated", none.cast("bigint").alias("turn"))
    # a turn counts once, however many rows it has
    seen = placed.where(F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    seen = seen.select("conv_id", none.cast(pieces.schema["piece"].dataType).alias("piece"),
                       *[F.lit(0).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated")], "turn")
    wide = [F.col(c).cast("decimal(38,0)") for c in ("high", "low", "n_turns")]
    return (pieces.unionByName(seen).groupBy("conv_id")
            .agg(F.array_sort(F.collect_list("piece")).alias("pieces"), F.max("turn").alias("high"), F.min("turn").alias("low"),
                 F.count("turn").alias("n_turns"), *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated")])
            .select("conv_id", F.array_join("pieces.piece", "").alias("signature"),
                    F.when(F.col("n_turns") == 0, F.lit(0)).otherwise((wide[0] - wide[1] + 1 - wide[2]).try_cast("bigint"))
                    .cast("bigint").alias("gaps"), "blank", "duplicate", "truncated"))


# -------------------------------------------------------------- automaton

class Shape:
    """Costs to go from the four states, less the smallest, and the first
    letter of the best audit suffix in each ('' where it ends)."""

    __slots__ = ("costs", "letters")

    def __init__(self, costs: tuple[int, ...], letters: tuple[str, ...]) -> None:
        self.costs, self.letters = costs, letters


def _with_inserts(best: list[tuple[int, str]]) -> tuple[int, Shape]:
    """Smallest cost and shape once inserted rows may come first."""
    for _ in range(len(best)):
        best = [min(own, (best[NEXT_STATE[g]][0] + COST["I"], "I")) for g, own in enumerate(best)]
    base = min(c for c, _ in best)
    return base, Shape(tuple(c - base for c, _ in best), tuple(x for _, x in best))


def after(state: int, letter: str, role_class: str) -> int:
    """The state once a row is kept or reroled, or one is inserted."""
    return 1 if letter == "K" and role_class == "s" else NEXT_STATE[state]


class Automaton:
    """The nodes of the signature read last, its end first. ``made`` counts
    the nodes made so far, ``worked_out`` the different steps computed."""

    def __init__(self) -> None:
        base, end = _with_inserts([(0 if g in DONE else FAR, "") for g in range(4)])
        self.word, self.shapes, self.costs, self.illegal = "", [end], array("q", [base]), array("q", [0])
        self.steps: dict[tuple[str, Shape], tuple[int, Shape]] = {}
        self.unique: dict[tuple, Shape] = {(end.costs, end.letters): end}
        self.made = self.worked_out = 0

    @staticmethod
    def class_of(symbol: str) -> str:
        return "suao"[int(symbol) - 1] if symbol.isdigit() else symbol.lower()

    def _step(self, symbol: str, then: Shape) -> tuple[int, Shape]:
        """A node's costs and letters from those of the node behind it."""
        if (known := self.steps.get((symbol, then))) is not None:
            return known
        role, extra, best = self.class_of(symbol), int(symbol.isupper()), []
        for g in range(4):
            options = [(COST["D"] + then.costs[g], "D")]
            if not symbol.isdigit():
                if role == NEXT_ROLE[g] or (role == "s" and g == 0):
                    options.append((COST["K"] + extra + then.costs[after(g, "K", role)], "K"))
                options.append((COST["R"] + extra + then.costs[NEXT_STATE[g]], "R"))
            best.append(min(options))
        base, shape = _with_inserts(best)
        shape = self.unique.setdefault((shape.costs, shape.letters), shape)
        self.worked_out += 1
        self.steps[symbol, then] = base, shape
        return base, shape

    def read(self, signature: str) -> tuple[int, int, str]:
        """(cost, illegal neighbours, audit) of a signature."""
        word = signature[::-1]
        kept = len(os.path.commonprefix([word, self.word]))
        for stack in (self.shapes, self.costs, self.illegal):
            del stack[kept + 1:]
        for at in range(kept, len(word)):
            base, shape = self._step(word[at], self.shapes[-1])
            wrong = at > 0 and self.class_of(word[at]) + self.class_of(word[at - 1]) not in LEGAL
            self.shapes.append(shape)
            self.costs.append(self.costs[-1] + base)
            self.illegal.append(self.illegal[-1] + wrong)
            self.made += 1
        self.word = word
        return self.costs[-1] + self.shapes[-1].costs[0], self.illegal[-1], self._audit(signature)

    def _audit(self, signature: str) -> str:
        state, letters = 0, []
        for at in range(len(signature), -1, -1):
            shape = self.shapes[at]
            while (letter := shape.letters[state]) == "I":
                letters.append("I")
                state = NEXT_STATE[state]
            if at:
                letters.append(letter)
                if letter != "D":
                    state = after(state, letter, self.class_of(signature[-at]))
        return "".join(letters)


def audits(found: DataFrame) -> DataFrame:
    """``(signature, cost, illegal, audit)`` of the different signatures in
    ``found``, sorted by their reversed text so that suffixes are shared."""
    schema = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, held, size = Automaton(), [], 0
        for b in batches:
            for s in b.column(0):
                cost, illegal, audit = automaton.read(s.as_py())
                held.append({"signature": s.as_py(), "cost": cost, "illegal": illegal, "audit": audit})
                size += 200 + len(audit)
                if size >= HOLD_CHARS:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    turned = F.reverse("signature")
    words = found.select("signature").distinct().repartitionByRange(turned).sortWithinPartitions(turned)
    return words.mapInArrow(run, "signature string, cost bigint, illegal bigint, audit string")


def repair_plan(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``
    of every conversation in ``rows`` (``turns``) and, with nothing to mend, of
    every further ``conv_id`` in ``ids``."""
    found = written(signatures(rows), "conv-signatures")
    plan = found.join(audits(found), "signature").select(*PLAN)
    if ids is None:
        return plan
    zeros = [F.lit(0).cast("bigint").alias(c) for c in PLAN[1:-1]]
    named = ids.select(F.col("conv_id").cast("bigint").alias("conv_id"), *zeros, F.lit("").alias("audit"))
    # gaps may be NULL, so the plan's own row is told apart by the audit's order, not by its numbers
    both = plan.withColumn("own", F.lit(1)).unionByName(named.distinct().withColumn("own", F.lit(0)))
    return both.groupBy("conv_id").agg(F.max_by(F.struct(*PLAN[1:]), "own").alias("p")).select("conv_id", "p.*")


# ----------------------------------------------------------------- repair

def apply_audit(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation, a row at a time."""
    state, at = 0, 0

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal state, at
        while audit[at:at + 1] == "I":
            yield "I", NAMES[NEXT_ROLE[state]], ""
            state, at = NEXT_STATE[state], at + 1

    for role, text in rows:
        yield from inserted()
        letter, at = audit[at], at + 1
        if letter == "D":
            continue
        yield letter, NAMES[NEXT_ROLE[state]] if letter == "R" else role, text
        state = after(state, letter, role[:1])
    yield from inserted()
    if at != len(audit):
        raise ValueError("the audit is longer than its conversation")


def _sorted_with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each conversation's plan as a row before its rows, in order."""
    header = F.struct(*[F.col(c) for c in PLAN]).alias("plan")
    heads = plan.select("conv_id", F.lit(0).alias("seq"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), *[F.lit(0).cast("bigint").alias(h) for h in ("h1", "h2")], header)
    body = rows.select("conv_id", F.lit(1).alias("seq"), "turn", "role", "text", *_hashes(),
                       F.lit(None).cast(heads.schema["plan"].dataType).alias("plan"))
    return (heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "seq", *ORDER[1:])
            .select("plan", "role", "text"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(plan, its rows) of each conversation of a sorted stream. The rows must
    be read before the next conversation is asked for."""
    def stream() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(k) for k in range(3)), strict=True)

    source, head = stream(), None

    def body() -> Iterator[tuple[str, str]]:
        nonlocal head
        head = None
        for plan, role, text in source:
            if plan.is_valid:
                head = plan
                return
            yield role.as_py(), text.as_py()

    first = next(source, None)
    head = first[0] if first is not None else None
    while head is not None:
        yield head.as_py(), body()


def repaired_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the repaired conversations,
    their rows numbered from 0, with the edit each one had."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for head, body in _conversations(batches):
            for place, (edit, role, text) in enumerate(apply_audit(head["audit"], body)):
                held.append({"conv_id": head["conv_id"], "place": place, "edit": edit, "role": role, "text": text})
                size += 200 + len(text)
                if size >= HOLD_CHARS:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return _sorted_with_plan(rows, plan).mapInArrow(run, "conv_id bigint, place bigint, edit string, role string, text string")


def repaired_digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``repaired_sha256``: of the repaired ``role:text`` rows,
    newline-joined."""
    schema = pa.schema([(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in [*PLAN, "repaired_sha256"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for head, body in _conversations(batches):
            digest = hashlib.sha256()
            for k, (_, role, text) in enumerate(apply_audit(head["audit"], body)):
                digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            held.append(head | {"repaired_sha256": digest.hexdigest()})
            size += 300 + len(head["audit"])
            if size >= HOLD_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return _sorted_with_plan(rows, plan).mapInArrow(run, PLAN_DDL + ", repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, audited and repaired."""
    given = turns(read_table(spark, sf_dir, "conversations"))
    rows = damaged(given)
    return repaired_digests(rows, repair_plan(rows, given.select("conv_id")))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
SQL: dict[str, str] = {}
