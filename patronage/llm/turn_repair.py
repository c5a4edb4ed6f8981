"""Repair of damaged conversations by a grammar-compressed transfer of states.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Turns
may be kept, given the role that fits, deleted, or inserted without text; the
cheapest edits are wanted, of those the least string of their initials. With a
state for what has been written last, each turn is a 4 x 4 matrix of (cost,
audit string) and a conversation the product of its turns' matrices, costs added
and alternatives brought to the least (cost, audit). Two audits of one cost
between the same states are never prefixes of each other (each has one letter a
turn besides its inserts, and inserts cost), so the least of a product is made of
least parts, and any bracketing gives the same.

Turns become symbols of role and fault, conversations are cut into stretches of
at most ``STRETCH`` different rows, and equal stretches are worked out once. The
stretches of a batch are compressed with Re-Pair (the most frequent pairs of
neighbouring symbols become symbols of their own, until no pair stands twice);
each rule's matrix is the product of its two parts', so it is taken once for all
conversations that have it. Audits in matrices are ropes: a product joins two in
one step, and ties are told by descending to the first difference.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import batches_of
from patronage.session import materialize

#: Costs of the edits, and what a truncated turn adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a stretch are at most 2 to this power; symbols that one grammar is made from; matrices that a task keeps.
STRETCH, SYMBOLS, KEPT = 9, 1 << 16, 1 << 15
#: Pairs that become rules in one pass.
PAIRS = 64
#: States: nothing written, system, user, assistant. What may be written, and where it leads.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"u": "user", "a": "assistant"}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
P, B = (1 << 61) - 1, 1_000_003


class Rope:
    """A string as a tree of its parts, with length and hash."""
    __slots__ = ("n", "hash", "power", "left", "right", "letter")

    def __init__(self, left=None, right=None, letter=""):
        self.left, self.right, self.letter = left, right, letter
        if left is not None:
            self.n, self.power = left.n + right.n, left.power * right.power % P
            self.hash = (left.hash * right.power + right.hash) % P
        else:
            self.n, self.hash, self.power = len(letter), ord(letter) if letter else 0, B if letter else 1

    def __add__(self, other: Rope) -> Rope:
        return other if not self.n else self if not other.n else Rope(self, other)

    def __lt__(self, other: Rope) -> bool:
        if not self.n or not other.n:
            return self.n < other.n
        one, two = [self], [other]
        while one and two:
            a, b = one.pop(), two.pop()
            if a is b or (a.n == b.n and a.hash == b.hash):
                continue
            if a.n == b.n == 1:
                return a.letter < b.letter
            # Open the longer (both, if equal): the parts that follow line up again.
            big = max(a.n, b.n)
            for x, stack in ((a, one), (b, two)):
                if x.n == big:
                    stack += [x.right, x.left]
                else:
                    stack.append(x)
        return bool(two)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.letter)
            else:
                todo += [x.right, x.left]
        return "".join(out)


NONE = Rope()
LETTER = {c: Rope(letter=c) for c in "DIKR"}
#: (from, to) -> (cost, audit); what is not there cannot be.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def least(m: Matrix, at: tuple[int, int], cost: int, audit: Rope) -> None:
    old = m.get(at)
    if old is None or cost < old[0] or (cost == old[0] and audit < old[1]):
        m[at] = (cost, audit)


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (f, m), (ca, ra) in a.items():
        for t in range(4):
            y = b.get((m, t))
            if y is not None:
                old = out.get((f, t))
                if old is None or ca + y[0] <= old[0]:
                    least(out, (f, t), ca + y[0], ra + y[1])
    return out


def _inserts() -> Matrix:
    out: Matrix = {}
    for f in range(4):
        at, cost, audit = f, 0, NONE
        while (f, at) not in out:
            out[f, at] = (cost, audit)
            at, cost, audit = STEPS[at, WANTED[at]], cost + INSERT, audit + LETTER["I"]
    return out


INSERTS = _inserts()


def turn_matrix(symbol: str) -> Matrix:
    """Inserts, then one turn. A symbol is the role's initial (o: any other), in
    upper case if truncated, or x if the turn must be deleted."""
    own: Matrix = {}
    more = TRUNCATED if symbol.isupper() else 0
    for f in range(4):
        least(own, (f, f), DELETE, LETTER["D"])
        if symbol == "x":
            continue
        if (f, symbol.lower()) in STEPS:
            least(own, (f, STEPS[f, symbol.lower()]), more, LETTER["K"])
        least(own, (f, STEPS[f, WANTED[f]]), REROLE + more, LETTER["R"])
    return times(INSERTS, own)


BASE = {c: turn_matrix(c) for c in "suaoSUAOx"}


def re_pair(seqs: list[str]) -> tuple[dict[str, str], list[str]]:
    """(rules, compressed sequences): a rule's symbol stands for its two. No
    pair stands twice in what is left."""
    text, rules, new = "\n".join(seqs), {}, 0x10000
    while True:
        counts = Counter(zip(text, text[1:], strict=False))
        often = sorted(((-n, p) for p, n in counts.items() if n > 1 and "\n" not in p))
        taken: set[str] = set()
        made = 0
        for _, p in often:
            if made < PAIRS and not taken & set(p):
                rules[chr(new)] = "".join(p)
                text = text.replace("".join(p), chr(new))
                taken |= set(p)
                made, new = made + 1, new + 1
        if not made:
            return rules, text.split("\n")


def transfers(seqs: list[str], memo: dict[str, Matrix] | None = None) -> list[Matrix]:
    """The matrix of each sequence of symbols. ``memo`` keeps rules' matrices by
    what they stand for, over several calls."""
    memo = {} if memo is None else memo
    rules, packed = re_pair(seqs)
    matrix, says = dict(BASE), {c: c for c in BASE}
    for new, (a, b) in rules.items():  # parts come before what they are part of
        says[new] = whole = says[a] + says[b]
        known = memo.get(whole)
        matrix[new] = times(matrix[a], matrix[b]) if known is None else known
        if known is None and len(memo) < KEPT and len(whole) <= 64:
            memo[whole] = matrix[new]
    out = []
    for s in packed:
        m: Matrix = {(f, f): (0, NONE) for f in range(4)}
        for c in s:
            m = times(m, matrix[c])
        out.append(m)
    return out


def finish(m: Matrix) -> tuple[int, Rope]:
    """The cheapest way from nothing written to an end, inserts at the end included."""
    done, best = times(m, INSERTS), {}
    for t in ENDS:
        if (0, t) in done:
            least(best, (0, 0), *done[0, t])
    return best[0, 0]


def illegal_pairs(heads: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(heads, heads[1:], strict=False))


def text_rope(s: str) -> Rope:
    """A balanced rope of a string."""
    parts = [LETTER[c] for c in s]
    while len(parts) > 1:
        parts = [parts[i] + parts[i + 1] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else NONE


def joined(stretches: list[dict]) -> tuple[int, str, int, list[tuple[int, int, str]]]:
    """(cost, audit, illegal pairs, parts) of a conversation from its stretches in
    order, each with its matrix; a part is (stretch, state before, audit)."""
    # The best way to each state so far, as (cost, audit, index of the stretch's entry, way before).
    ways: dict[int, tuple] = {0: (0, NONE, None, None)}
    illegal, tail = 0, ""
    for k, s in enumerate(stretches):
        entries: dict[int, list] = {}
        m: Matrix = {(e["f"], e["t"]): (e["cost"], text_rope(e["audit"])) for e in s["matrix"]}
        if k == len(stretches) - 1:
            m = times(m, INSERTS)
        for (f, t), (cost, audit) in m.items():
            if f in ways:
                entries.setdefault(t, []).append((ways[f][0] + cost, ways[f][1] + audit, (s["stretch"], f, audit), ways[f]))
        new = {}
        for t, options in entries.items():
            best = options[0]
            for o in options[1:]:
                if o[0] < best[0] or (o[0] == best[0] and o[1] < best[1]):
                    best = o
            new[t] = best
        ways = new
        illegal += s["illegal"] + (tail != "" and tail + s["head"] not in LEGAL)
        tail = s["tail"]
    best = None
    for t in ENDS:
        if t in ways and (best is None or ways[t][0] < best[0] or (ways[t][0] == best[0] and ways[t][1] < best[1])):
            best = ways[t]
    parts, at = [], best
    while at[2] is not None:
        parts.append((at[2][0], at[2][1], str(at[2][2])))
        at = at[3]
    return best[0], str(best[1]), illegal, parts[::-1]


def edited(rows: Iterable[tuple[str, str, int]], state: int, audit: str) -> list[tuple[str, str]]:
    """(role, text) of the repaired turns: rows are (role, text, copies)."""
    out, letters = [], iter(audit)

    def put(role: str | None, text: str) -> None:
        nonlocal state
        want = WANTED[state]
        out.append((NAMES[want] if role is None else role, text))
        state = STEPS[state, want if role is None else role[0]]
    for role, text, copies in rows:
        for _ in range(copies):
            while (c := next(letters)) == "I":
                put(None, "")
            if c != "D":
                put(role if c == "K" else None, text)
    for _ in letters:
        put(None, "")
    return out


def faults(turns: DataFrame) -> DataFrame:
    """The turns in order, copies of a row as one: key (conversation), turn, role,
    text, copies, pos (rising in a conversation's order), blank, truncated,
    initial (s, u, a, o) and again (the same role and text stand earlier).

    Rows are spread by ranges of their order, so a conversation may span several
    tasks. Ties of turn go by role and text.
    """
    space = " \t\n\x0b\f\r"
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.groupBy("key", "turn", "role", "text").agg(F.count("*").alias("copies"))
    opening = F.substring("text", 1, 64).alias("opening")
    rows = rows.withColumn("opening", opening).repartitionByRange("key", "turn", "role", "opening") \
        .sortWithinPartitions("key", "turn", "role", "text").drop("opening")
    kept = F.rtrim("text", F.lit(space))
    initial = F.substring("role", 1, 1)
    rows = materialize(rows.select(
        "key", "turn", "role", "text", "copies", F.monotonically_increasing_id().alias("pos"),
        F.md5(F.to_json(F.struct("role", "text"))).alias("said"), (F.char_length(kept) == 0).alias("blank"),
        ((F.char_length(kept) > 0) & ~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial")))
    # The first of each saying; written, so that the join can split a hot one.
    first = materialize(rows.where("not blank").groupBy("key", "said").agg(F.min("pos").alias("first")))
    seen = rows.join(first, ["key", "said"], "left")
    return seen.withColumn("again", F.coalesce(F.col("pos") > F.col("first"), F.lit(False))).drop("first", "said")


def stretches(rows: DataFrame) -> DataFrame:
    """key, stretch, symbols, heads (initials), blank, duplicate, truncated of
    every stretch of a conversation's rows, written."""
    fine = ~F.col("blank") & ~F.col("again")
    symbol = F.when(~fine, "x").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))
    copies = F.col("copies").cast("int")

    def spelled(c: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", c))), lambda x: x[c]), "").alias(c)
    marked = rows.select("key", F.shiftright("pos", STRETCH).alias("stretch"), "pos", "blank", "again", "truncated", "copies",
                         F.concat(symbol, F.repeat(F.lit("x"), copies - 1)).alias("symbols"),
                         F.repeat("initial", copies).alias("heads"))
    total = [F.sum(c).cast("long").alias(n) for n, c in (
        ("blank", F.when(F.col("blank"), F.col("copies")).otherwise(0)),
        ("duplicate", F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.when(F.col("again"), 0).otherwise(1))),
        ("truncated", F.when(fine & F.col("truncated"), 1).otherwise(0)))]
    return materialize(marked.groupBy("key", "stretch").agg(spelled("symbols"), spelled("heads"), *total))


ENTRY = pa.struct([("f", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])


def solved(parts: DataFrame) -> DataFrame:
    """(symbols, heads, several) with the best cost and audit of a whole
    conversation that is this stretch, its matrix where several is true, and
    illegal, head and tail of the initials."""
    kind = "symbols string, heads string, cost long, audit string, illegal long, head string, tail string, " \
           "matrix array<struct<f: int, t: int, cost: long, audit: string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, Matrix] = {}
        for b in batches:
            rows = list(zip(*[c.to_pylist() for c in b.columns], strict=True))
            while rows:
                size, n = 0, 0
                while n < len(rows) and (n == 0 or size + len(rows[n][0]) <= SYMBOLS):
                    size, n = size + len(rows[n][0]), n + 1
                now, rows = rows[:n], rows[n:]
                out = []
                for (symbols, heads, several), m in zip(now, transfers([r[0] for r in now], memo), strict=True):
                    cost, audit = finish(m)
                    whole = [{"f": f, "t": t, "cost": c, "audit": str(a)} for (f, t), (c, a) in m.items()] if several else None
                    out.append((symbols, heads, cost, str(audit), illegal_pairs(heads), heads[:1], heads[-1:], whole))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(ENTRY)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=["symbols", "heads", "cost", "audit", "illegal", "head", "tail", "matrix"])
    return parts.select("symbols", "heads", "several").mapInArrow(run, kind)


def assembled(several: DataFrame) -> DataFrame:
    """key, cost, audit, illegal, parts of conversations of several stretches."""
    kind = "key string, cost long, audit string, illegal long, parts array<struct<stretch: long, f: int, audit: string>>"
    part = pa.struct([("stretch", pa.int64()), ("f", pa.int32()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, found in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                cost, audit, illegal, parts = joined(found.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([cost], pa.int64()), pa.array([audit]), pa.array([illegal], pa.int64()),
                     pa.array([[{"stretch": s, "f": f, "audit": a} for s, f, a in parts]], pa.list_(part))],
                    names=["key", "cost", "audit", "illegal", "parts"])
    grouped = several.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("stretch", "head", "tail", "illegal", "matrix"))).alias("found"))
    return grouped.mapInArrow(run, kind)


def repair(turns: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(summary, repaired) of conversations (conv_id, turn, role, text).

    summary has a row for each conversation, and for each conv_id of ``ids``:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. repaired has
    conv_id, stretch and the stretch's repaired turns, an array of (role, text);
    a conversation's stretches are in the order of their numbers.

    Null roles and texts count as one space, rows of a null conv_id are one
    conversation, a null turn comes first, ties of turn go by role and text, rows
    that repeat are turns of their own; conversations of ``ids`` without turns
    have zeros and an empty audit; an empty table gives no rows; other columns
    are not read. An audit is one value, and so are a long conversation's
    stretches while they are put together; texts are not.
    """
    batches_of(turns.sparkSession)
    rows = materialize(faults(turns))
    cut = stretches(rows)
    count = cut.groupBy("key").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    count = materialize(count)
    marked = cut.select("key", "stretch", "symbols", "heads").join(count.select("key", (F.col("n") > 1).alias("several")), "key")
    answers = materialize(solved(marked.groupBy("symbols", "heads").agg(F.max("several").alias("several"))))
    found = marked.join(answers, ["symbols", "heads"])
    short = found.where("not several").select(
        "key", "cost", "audit", "illegal",
        F.array(F.struct("stretch", F.lit(0).alias("f"), "audit")).alias("parts"))
    done = materialize(short.unionByName(assembled(found.where("several"))))
    gaps = rows.where("turn is not null").groupBy("key", "turn").agg(F.count("*").alias("n")).groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    summary = count.join(done.drop("parts"), "key").join(gaps, "key", "left")
    if ids is not None:
        every = ids.select(F.coalesce(F.col("conv_id").cast("bigint").cast("string"), F.lit("")).alias("key")).distinct()
        summary = every.join(summary, "key", "left")

    def id_of(key: str) -> Column:
        return F.when(F.col(key) != "", F.col(key).cast("bigint")).alias("conv_id")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    summary = summary.select(id_of("key"), *zero, F.coalesce("audit", F.lit("")).alias("audit"))

    texts = rows.groupBy("key", F.shiftright("pos", STRETCH).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text", "copies"))).alias("rows"))
    parts = done.select("key", F.explode("parts").alias("part")).select("key", "part.*")
    pair = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [[{"role": r, "text": t} for r, t in edited([(x["role"], x["text"], x["copies"]) for x in rows], f, audit)]
                    for rows, f, audit in zip(*[c.to_pylist() for c in b.columns[2:]], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.list_(pair))],
                                             names=["key", "stretch", "turns"])
    repaired = texts.join(parts, ["key", "stretch"]).select("key", "stretch", "rows", "f", "audit") \
        .mapInArrow(run, "key string, stretch long, turns array<struct<role: string, text: string>>")
    return summary, repaired.select(id_of("key"), "stretch", "turns")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with planted damage by a checksum of conversation and turn, of
    twenty rows one each: left out, text emptied, without its full stops, said
    twice, role set to user. Nulls count as one space."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" "))
    h = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        text.alias("text"), h.alias("h")).where("h != 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1))).alias("n")) \
        .drop("n")


def repair_digests(turns: DataFrame) -> DataFrame:
    """The summary of the damaged turns' repair for every conversation of
    ``turns``, and repaired_sha256 of its turns (role:text, a line each). The
    digest needs a conversation's text in one value."""
    summary, repaired = repair(damaged(turns), turns.select("conv_id"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    said = repaired.where("size(turns) > 0").groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("stretch", lines.alias("x")))), lambda s: s["x"]), "\n").alias("said"))
    said = said.select(F.col("conv_id").alias("c"), F.sha2(F.col("said").cast("binary"), 256).alias("sha"))
    return summary.join(said, F.col("conv_id").eqNullSafe(F.col("c")), "left") \
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
