"""Conversation structure repair over a suffix-shared automaton.

A conversation's rows, in order, become a signature: one symbol for each row,
its role's initial and its first fault. What it costs to repair the rest of a
conversation depends only on the symbols still to come and on the grammar state
(roles must read ``(s?(ua)+)?``), so all conversations whose signatures end
alike share that node: cost-to-go and the first letter of the best audit are
worked out once for each node and state, from the end.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only one for blank
rows and duplicates), Insert an empty user or assistant row 3; a truncated row
that stays adds 3. From a state each letter leads to one next state, so of
equally cheap audits the ASCII-least takes the least letter at each step, and a
node needs no more than a cost and a letter for each state.

How it is spread: (1) facts of each row are taken where it is read, without its
text; rows seen earlier in their conversation come from a grouped minimum;
(2) rows sorted by conversation stream into signatures; (3) signatures, copies
included, are dealt and sorted by their reversal, so those that share a suffix
follow each other: a task keeps one path of nodes, cut back to the common
suffix and grown again, and a signature that most conversations have is spread
over tasks; (4) audits and rows with texts meet by conversation in one sorted
stream that hashes the repaired rows. No task holds a conversation's rows.

Defined results: NULL roles and texts are one space, a NULL turn comes first
(and is one space in the damage's key); NULL ids are one conversation; rows of one turn come in the order of
a hash of role and text, so repeated rows stand together; a conversation
without rows has zeros, an empty audit and the empty text's hash; an empty
table gives an empty result; other columns are ignored. Rows of any length are
streamed.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscheck.session import materialize

# Characters that are blank, that end a sentence, costs of edits.
BLANKS = "\t\n\x0b\x0c\r "
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to, and its role.
GROWS = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
ACCEPTS = (True, False, False, True)
#: Roles' initials that a state takes unchanged.
TAKES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})

_EARLIEST = "-10000000000000000000"
_FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long"


# --- rows -------------------------------------------------------------------

def cleaned(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with one space for a NULL role or text."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``cleaned`` dropped, emptied, stripped of sentence ends, repeated or reroled by crc32(``conv_id:turn``) % 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = rows.withColumn("_kind", kind)
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return (rows.filter("_kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copies"))
            .select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_copy")).drop("_copy"))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their place in the conversation: ``ord`` by turn (NULL first), then ``key`` of role and text."""
    key = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    ord_ = F.coalesce(F.col("turn").cast("decimal(20,0)"), F.lit(_EARLIEST).cast("decimal(20,0)"))
    return rows.select("conv_id", "turn", ord_.alias("ord"), key.alias("key"), "role", "text")


def _symbol(initial: Column, blank: Column, cut: Column) -> Column:
    """One letter for a row: ``d`` if it must go, else its role's initial (``x``: no legal one), upper-case if truncated."""
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return F.when(blank, "d").when(cut, F.upper(letter)).otherwise(letter)


def facts(rows: DataFrame) -> DataFrame:
    """Each row without its text: ``(conv_id, turn, ord, key, initial, symbol, first_ord)``.

    ``first_ord`` is the earliest place of the same role and text in the
    conversation, where it has more than one.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(bare, -1, 1)
    initial = F.substring("role", 1, 1)
    narrow = _placed(rows).select("conv_id", "turn", "ord", "key", initial.alias("initial"),
                                  _symbol(initial, bare == "", ~last.isin(*ENDS)).alias("symbol"))
    again = (narrow.groupBy(F.col("conv_id").alias("_c"), F.col("key").alias("_k")).agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("_n"))
             .filter("_n > 1").drop("_n"))
    return narrow.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k")), "left").drop("_c", "_k")


# --- signatures -------------------------------------------------------------

class _Conversation:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns = 0
        self.before = None  # the last row's (turn, key) and initial
        self.initial = None

    def add(self, turn, ord_, key, initial, symbol, first_ord):
        repeated = first_ord is not None and (ord_ > first_ord or self.before == (turn, key))
        if symbol == "d":
            self.blank += 1
        elif repeated:
            self.duplicate += 1
            symbol = "d"
        elif symbol.isupper():
            self.truncated += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.before, self.initial = (turn, key), initial
        self.symbols += symbol.encode()

    def row(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.symbols.decode()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of a bounded number of rows and characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or chars >= most:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTS = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal")]
_SIGNED = pa.schema([("conv_id", pa.int64()), *_COUNTS, ("signature", pa.string())])
_SOLVED = pa.schema([("conv_id", pa.int64()), *_COUNTS, ("cost", pa.int64()), ("audit", pa.string())])


def signatures(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, signature)`` of each conversation in ``rows`` or ``ids``."""
    marked = facts(rows).withColumn("kind", F.lit(1))
    named = (ids if ids is not None else rows).select("conv_id").distinct().withColumn("kind", F.lit(0))
    both = marked.unionByName(named, allowMissingColumns=True)
    names = ["conv_id", "kind", "turn", "ord", "key", "initial", "symbol", "first_ord"]

    def stream(batches):
        now = None
        for b in batches:
            for conv_id, kind, *row in zip(*(b.column(n).to_pylist() for n in names)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield now.row()
                    now = _Conversation(conv_id)
                if kind:
                    now.add(*row)
        if now is not None:
            yield now.row()

    return (both.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "ord", "key")
            .mapInArrow(lambda bs: _batches(stream(bs), _SIGNED), f"conv_id long, {_FACTS}, signature string"))


# --- cost-to-go -------------------------------------------------------------

class SuffixPath:
    """Nodes of the suffixes of one signature, from the empty one on.

    ``solve`` is given reversed signatures; nodes that the one before shares
    stay as they are, so signatures in sorted order make each node once.
    """

    def __init__(self):
        self.word = ""
        self.nodes_made = 0
        self.cost = [array("q") for _ in range(4)]
        self.letter = [bytearray() for _ in range(4)]
        # the empty suffix: what is still to be inserted
        for state, (cost, letter) in enumerate(((0, 0), (2 * INSERT, 73), (INSERT, 73), (0, 0))):
            self.cost[state].append(cost)
            self.letter[state].append(letter)

    def _grow(self, symbol: str) -> None:
        rest = [c[-1] for c in self.cost]
        costs, letters = [0] * 4, [""] * 4
        for state in range(4):
            options = [(DELETE + rest[state], "D")]
            if symbol != "d":
                extra = TRUNCATED if symbol.isupper() else 0
                kept = TAKES[state].get(symbol.lower())
                if kept is not None:
                    options.append((KEEP + extra + rest[kept], "K"))
                options.append((REROLE + extra + rest[GROWS[state]], "R"))
            costs[state], letters[state] = min(options)
        for _ in range(3):
            for state in range(4):
                option = (INSERT + costs[GROWS[state]], "I")
                if option < (costs[state], letters[state]):
                    costs[state], letters[state] = option
        for state in range(4):
            self.cost[state].append(costs[state])
            self.letter[state].append(ord(letters[state]))
        self.nodes_made += 1

    def solve(self, word: str) -> tuple[int, str]:
        """(cost, audit) of the signature whose reversal is ``word``."""
        low, high = 0, min(len(word), len(self.word))
        while low < high:  # the longest common start
            mid = (low + high + 1) // 2
            low, high = (mid, high) if word[low:mid] == self.word[low:mid] else (low, mid - 1)
        for state in range(4):
            del self.cost[state][low + 1:], self.letter[state][low + 1:]
        for symbol in word[low:]:
            self._grow(symbol)
        self.word = word
        audit, state, at = bytearray(), START, len(word)
        while at or not ACCEPTS[state]:
            letter = self.letter[state][at]
            audit.append(letter)
            if letter == 75:  # K
                state = TAKES[state][word[at - 1].lower()]
            elif letter != 68:  # R, I
                state = GROWS[state]
            at -= letter != 73
        return self.cost[START][len(word)], audit.decode()


def audits(signed: DataFrame) -> DataFrame:
    """``signed`` with ``cost`` and ``audit`` in place of its signature."""

    def stream(batches):
        path, last, found = SuffixPath(), None, None
        for b in batches:
            for *row, word in zip(*(b.column(n).to_pylist() for n in [*_SIGNED.names[:-1], "word"])):
                if word != last:
                    last, found = word, path.solve(word)
                yield *row, *found

    dealt = signed.withColumn("word", F.reverse("signature")).drop("signature")
    return (dealt.repartitionByRange("word", "conv_id").sortWithinPartitions("word", "conv_id")
            .mapInArrow(lambda bs: _batches(stream(bs), _SOLVED), f"conv_id long, {_FACTS}, cost long, audit string"))


# --- repaired rows ----------------------------------------------------------

def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired ``(role, text)`` rows, one at a time."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state = GROWS[state]
            at += 1
            yield ROLE_OF[state], ""

    for role, text in rows:
        yield from inserted()
        letter = audit[at]
        at += 1
        if letter == "K":
            state = TAKES[state][role[:1]]
            yield role, text
        elif letter == "R":
            state = GROWS[state]
            yield ROLE_OF[state], text
    yield from inserted()


_REPAIRED = pa.schema([*_SOLVED, ("repaired_sha256", pa.string())])
_REPAIRED_ROWS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _sorted_streams(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Each conversation's solved row, then its rows in order."""
    texts = _placed(rows).select("conv_id", F.lit(1).alias("kind"), "ord", "key", "role", "text")
    both = texts.unionByName(solved.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "ord", "key").drop("ord", "key")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """(solved row, its rows as they stream by); the rows must be read before the next."""
    names = [*_SOLVED.names, "kind", "role", "text"]
    flat = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names)))
    head = next(flat, None)
    while head is not None:
        following = None

        def rows():
            nonlocal following
            for row in flat:
                if not row[-3]:
                    following = row
                    return
                yield row[-2], row[-1]

        stream = rows()
        yield head[:len(_SOLVED)], stream
        for _ in stream:
            pass
        head = following


def repaired_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the conversations after their cheapest edits."""

    def stream(batches):
        for head, held in _conversations(batches):
            for place, (role, text) in enumerate(edited(head[-1], held)):
                yield head[0], place, role, text

    return _sorted_streams(rows, solved).mapInArrow(lambda bs: _batches(stream(bs), _REPAIRED_ROWS),
                                                    "conv_id long, place long, role string, text string")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation.

    ``rows`` are those of ``cleaned``; ``ids`` names conversations that may
    have none.
    """
    solved = audits(materialize(signatures(rows, ids), "structure-signatures"))

    def stream(batches):
        for head, held in _conversations(batches):
            digest, first = hashlib.sha256(), True
            for role, text in edited(head[-1], held):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            yield *head, digest.hexdigest()

    return _sorted_streams(rows, solved).mapInArrow(lambda bs: _batches(stream(bs), _REPAIRED),
                                                    f"conv_id long, {_FACTS}, cost long, audit string, repaired_sha256 string")


def op12_structure_repair(spark, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation of ``conversations`` after damage."""
    from corpuscheck.llm.tables import read

    rows = cleaned(read(spark, sf_dir, "conversations"))
    return repair(damaged(rows), rows)
