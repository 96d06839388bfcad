import hashlib
import heapq
import itertools
import random
import re
import zlib

from corpuscheck.llm import op12_structure as O

SCHEMA = ("conv_id long, turn long, role string, text string, kind string, ord string, key string, audit string, symbol string, "
          "signature string, word string, initial string, first_ord string, cost string, gaps string")
N_EXTRA = 11
GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def _damage(rows):
    """Rows of one conversation, in order, after damage."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)

    def place(r):
        return (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest())

    return sorted(out, key=place)


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def _cheapest(rows, faults):
    """Uniform-cost search over (cost, audit): the first full one is the cheapest, ASCII-least; roles checked by the pattern itself."""
    def may_go_on(roles):
        return any(GRAMMAR.fullmatch(roles + more) for more in ("", "a", "ua"))

    queue, done = [(0, "", "", 0, ())], set()
    while queue:
        cost, audit, roles, at, lines = heapq.heappop(queue)
        tail = (roles[-1:], at)
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, audit, "\n".join(lines)
        if tail in done:
            continue
        done.add(tail)
        for new in ("user", "assistant"):
            if may_go_on(roles + new[0]):
                heapq.heappush(queue, (cost + 3, audit + "I", roles + new[0], at, lines + (f"{new}:",)))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", roles, at + 1, lines))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] == "truncated" else 0
                if role[:1] and may_go_on(roles + role[:1]):
                    heapq.heappush(queue, (cost + more, audit + "K", roles + role[0], at + 1, lines + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    if may_go_on(roles + new[0]):
                        heapq.heappush(queue, (cost + 3 + more, audit + "R", roles + new[0], at + 1, lines + (f"{new}:{text}",)))


def _brute(table):
    out = []
    for conv_id in {r[0] for r in table}:
        rows = _damage([r[:4] for r in table if r[0] == conv_id])
        faults = _faults(rows)
        cost, audit, text = _cheapest(rows, faults)
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv_id, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def _table(seed, n=150):
    rng, out = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "so", "", " \n", "end. ", "…", "a\nb.", "Ünder.\t", "x", "y."]
    for conv_id in range(n):
        for turn in range(rng.randrange(0, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "superuser"])
            if rng.random() < 0.6:
                role = ("user", "assistant")[turn % 2]
            out.append((conv_id, turn + rng.choice([0, 0, 0, 3]), role, rng.choice(texts + [None, f"own {rng.random()}."])))
    out += [(None, 1, "user", "hello."), (None, None, "assistant", None), (-7, -3, "user", "a."), (-7, 9, "assistant", "b.")]
    out += [(500, None, "user", "same."), (500, None, "user", "same."), (500, 0, "user", "same."), (501, 4, "user", "z."), (501, 4, "user", "z.")]
    out += [(502, k, ("user", "assistant")[k % 2], "long " * 30_000 + str(k)) for k in range(3)]
    out += [(503, k, ("user", "assistant")[(k // 3) % 2], f"turn {k}" + "." * (k % 4 > 0)) for k in range(400)]
    dropped = next(t for t in itertools.count() if zlib.crc32(f"504:{t}".encode()) % 20 == 0)
    out.append((504, dropped, "user", "gone."))
    rng.shuffle(out)
    return out


def _frame(spark, table):
    return spark.createDataFrame([(*r, *"x" * N_EXTRA) for r in table], SCHEMA)


def _run(spark, table):
    rows = O.cleaned(_frame(spark, table))
    return sorted((tuple(r) for r in O.repair(O.damaged(rows), rows).collect()), key=str)


def test_against_brute_force(spark):
    """NULLs in every column, ties, repeated rows, empty and long texts, a long conversation, one that loses every row, clashing columns."""
    table = _table(3)
    want = _brute(table)
    assert _run(spark, table) == want
    assert any(r[0] == 504 and r[1:8] == (0, 0, 0, 0, 0, 0, "") for r in want)
    assert {c for r in want for c in r[7]} == set("DIKR")


def test_every_short_signature():
    """All signatures of up to four rows: cost and audit equal the search's."""
    row = {"s": ("system", "S."), "u": ("user", "U."), "a": ("assistant", "A."), "x": ("tool", "X.")}
    path, words = O.SuffixPath(), ["".join(w) for n in range(5) for w in itertools.product("suaxSUAXd", repeat=n)]
    rng = random.Random(2)
    for word in sorted(w[::-1] for w in words if len(w) < 4 or rng.random() < 0.1):
        signature = word[::-1]
        rows = [(k, *(row[c.lower()] if c != "d" else ("user", ""))) for k, c in enumerate(signature)]
        faults = ["blank" if c == "d" else "truncated" if c.isupper() else "" for c in signature]
        assert path.solve(word) == _cheapest(rows, faults)[:2], signature


def test_nodes_are_shared():
    """Sorted reversals make each distinct suffix once."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("uaUAd") for _ in range(rng.randrange(0, 9))) for _ in range(400)})
    path = O.SuffixPath()
    for w in words:
        path.solve(w)
    assert path.nodes_made == len({w[:n] for w in words for n in range(1, len(w) + 1)})


def test_repaired_rows_follow_the_grammar(spark):
    table = _table(5, 40)
    rows = O.cleaned(_frame(spark, table))
    solved = O.audits(O.signatures(O.damaged(rows), rows))
    got = sorted((r.conv_id if r.conv_id is not None else -1, r.place, r.role[:1]) for r in O.repaired_rows(O.damaged(rows), solved).collect())
    for _, run in itertools.groupby(got, lambda r: r[0]):
        assert GRAMMAR.fullmatch("".join(r[2] for r in run))


def test_many_copies_of_one_conversation(spark):
    """Copies that share a signature, more than half of all, are all answered."""
    table = [(c, k, r, f"{r} {k}.") for c in range(1, 2001) for k, r in enumerate(("user", "assistant", "user", "assistant"))]
    assert _run(spark, table) == _brute(table)


def test_empty_table(spark):
    assert _run(spark, []) == []


def test_query_over_given_tables(spark):
    from corpuscheck.llm.tables import read

    got = sorted((tuple(r) for r in O.op12_structure_repair(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == _brute([tuple(r) for r in read(spark, "/root/testdata/sf0.001", "conversations").collect()])
