import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from strataset.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, marks string, plan int, kind int"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append(1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def plain_plan(rows):
    """Cheapest edits by a search over prefixes, every partial result kept per state: forwards, with
    whole edit texts, unlike the operator."""
    states = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    # Partial audits are compared as texts only where they are equally long and cheap, so each number
    # of edits is kept apart.
    layers = {("", 0): (0, "", ())}

    def insertions(layers):
        for _ in range(3):
            for (state, n), (cost, audit, made) in list(layers.items()):
                for role in ("user", "assistant"):
                    to = states[state].get(role[0])
                    if to is not None and n < 2 * len(rows) + 4:
                        option = (cost + 3, audit + "I", (*made, (role, "")))
                        if (to, n + 1) not in layers or option[:2] < layers[to, n + 1][:2]:
                            layers[to, n + 1] = option
        return layers

    layers = insertions(layers)
    for (role, text), fault in zip(rows, faults_of(rows)):
        after = {}
        for (state, n), (cost, audit, made) in layers.items():
            options = [(state, cost + 4, "D", made)]
            if fault in (0, 3):
                extra = 3 * (fault == 3)
                if role[:1] in states[state] and role:
                    options.append((states[state][role[0]], cost + extra, "K", (*made, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in states[state]:
                        options.append((states[state][new[0]], cost + 3 + extra, "R", (*made, (new, text))))
            for to, c, edit, m in options:
                if (to, n + 1) not in after or (c, audit + edit) < after[to, n + 1][:2]:
                    after[to, n + 1] = (c, audit + edit, m)
        layers = insertions(after)
    ends = [v for (state, _), v in layers.items() if state in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def plain(rows, known):
    out = {}
    for c in known:
        own = [r for r in rows if r[0] == c]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = {r[1] for r in own} - {None}
        said = [(r[2], r[3]) for r in own]
        faults = faults_of(said)
        cost, audit, made = plain_plan(said)
        assert legal("".join(r[:1] for r, _ in made))
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (1, 2, 3)],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 1) for r in rows], SCHEMA)


def found(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_all_short_signatures_equal_a_plain_search():
    roles = {"s": "system", "u": "user", "a": "assistant", "": "tool"}
    nodes, total = conv.Suffixes(), 0
    cases = []
    for n in range(4):
        for kinds in product([(i, f) for i in "sua" for f in (0, 1, 3)] + [("", 0)], repeat=n):
            rows = [(roles[i], {0: f"t{k}.", 1: " ", 3: f"t{k}"}[f]) for k, (i, f) in enumerate(kinds)]
            cases.append(("".join(conv.letter(i, f) for i, f in kinds)[::-1], rows))
    for back, rows in sorted(cases):
        assert nodes.plan(back) == plain_plan(rows)[:2], rows
        total += len(back)
    # Sorted by their ends, a signature adds no more nodes than its suffixes that are new.
    suffixes = {b[:k] for b, _ in cases for k in range(1, len(b) + 1)}
    assert nodes.made == len(suffixes) < total


def test_small_cases_equal_brute_force(spark):
    rows = [
        (1, 0, "system", "Be nice."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes!"),
        (2, 5, "user", "a"), (2, 9, "user", "b."), (2, None, "assistant", "first."), (2, 9, "assistant", "b."),
        (3, 1, None, None), (3, 1, None, None), (3, 2, "", "x."), (3, 3, "User", "x."), (3, 4, "u", "end.\n \x0b"),
        (None, None, "user", "?"), (None, 2, "assistant", "ok."), (4, 1, "user", "same."), (4, 1, "user", "same."),
        (4, 1, "user", "same."), (4, 2, "assistant", "日本。"), (5, 0, "assistant", "   "), (6, 10**15, "user", "x" * 100_000),
    ]
    df = frame(spark, rows)
    as_is = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    ids = {r[0] for r in rows}
    assert found(conv.repair(df)) == plain(as_is, ids)
    assert found(conv.repair(conv.damage(df), known=df)) == plain(damaged(rows), ids)
    made = sorted(conv.repaired_turns(df).collect(), key=lambda r: (str(r.conv_id), r.position))
    for c in ids:
        said = "\n".join(f"{r.role}:{r.text}" for r in made if r.conv_id == c)
        assert hashlib.sha256(said.encode()).hexdigest() == plain(as_is, ids)[c][-1]
    assert conv.repair(df.limit(0)).count() == 0
    assert found(conv.repair(df.limit(0), known=df.limit(1)))[1] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())


def test_random_conversations_equal_brute_force(spark):
    pick = random.Random(7)
    rows = []
    for c in range(150):
        for _ in range(pick.randrange(1, 9)):
            rows.append((c, pick.choice([None, *range(6)]), pick.choice(["system", "user", "assistant", "assistant", "tool"]),
                         pick.choice(["a.", "b!", "c", " ", "d?"])))
    df = frame(spark, rows)
    assert found(conv.repair(conv.damage(df), known=df)) == plain(damaged(rows), {r[0] for r in rows})


@pytest.mark.parametrize("ids", ["string", "int"])
def test_a_conversation_with_a_third_of_the_rows(spark, ids):
    pick = random.Random(8)
    rows = [("0", t, pick.choice(["user", "assistant"]), f"t{pick.randrange(400)}{pick.choice(['.', ''])}") for t in range(600)]
    rows += [(str(c), t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for c in range(1, 200) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    df = df.withColumn("conv_id", df.conv_id.cast(ids))
    got = {str(k): v for k, v in found(conv.repair(df.repartition(6))).items()}
    nodes = conv.Suffixes()
    assert len(got) == 200 and len(set(got[str(c)] for c in range(1, 200))) == 1 and got["1"][5:7] == (0, "KKKKKK")
    faults = faults_of([(r, x) for c, _, r, x in rows if c == "0"])
    back = "".join(conv.letter(r[0], f) for (c, _, r, _), f in zip(rows, faults) if c == "0")[::-1]
    assert nodes.plan(back) == got["0"][5:7]
