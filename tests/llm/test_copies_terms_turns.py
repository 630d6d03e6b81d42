"""Near duplicates by SetSketch, source divergence and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from oracle_util import duck

from tidemark.llm import conversation_repair, divergence_audit, hirschberg, setsketch_dedup
from tidemark.llm.oracle import SOURCE_DIVERGENCE
from tidemark.llm.queries import QUERIES

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text, length):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + length]) for i in range(len(w) - length + 1)} if len(w) >= length else {tuple(w)} if w else set()


def groups_by_force(texts, percent, length):
    sets = [shingle_set(t, length) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    near = {p for h in holders.values() if len(h) > 1 for p in itertools.combinations(h, 2)}
    for i, j in near:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def near_copies(rng, base, count, share):
    out = []
    for _ in range(count):
        w = list(base)
        for k in rng.sample(range(len(w)), int(share * len(w))):
            w[k] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check_copies(spark, texts, percent=80, length=2):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, node string, row int").repartition(5)
    got = {r.doc_id: r for r in setsketch_dedup.near_duplicates(docs, percent, length).collect()}
    want, sizes = groups_by_force(texts, percent, length)
    assert len(got) == len(texts)
    assert [(got[i].component_id, got[i].n_shingles, got[i].kept) for i in range(len(texts))] == [(c, n, c == i) for i, (c, n) in enumerate(zip(want, sizes, strict=True))]
    return want


def test_copies_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    want = check_copies(spark, [r.text for r in docs])
    assert len(set(want)) < len(want)


def test_copies_on_odd_texts(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(200_000))
    texts = [None, "", " \n", "one", "One", "one two", "two one", "a b c d e", "a b c d f", "a b c d e f", long, long + " end", "x " * 900, "x " * 901]
    check_copies(spark, texts)


def test_copies_in_one_hot_group(spark, monkeypatch):
    """A group whose members link with the original, but hardly with each other, beside one of close copies."""
    monkeypatch.setattr(setsketch_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    other = [f"c{k}" for k in range(90)]
    texts = [*near_copies(rng, base, 30, 0.05), " ".join(base), *near_copies(rng, other, 40, 0.01), *[" ".join(other)] * 40, *near_copies(rng, base, 10, 0.12)]
    want = check_copies(spark, texts)
    assert max(want.count(c) for c in set(want)) > 60


def test_copies_with_repeated_and_null_ids(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, a), (1, b), (2, b), (None, a), (3, None), (2, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in setsketch_dedup.near_duplicates(docs).collect()), key=str)
    want = [(1, 6, 1, True), (1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False), (3, 0, 3, True), (None, 6, None, True)]
    assert got == sorted(want, key=str)
    assert setsketch_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 6000).astype(np.uint64)
    a, b = pool[:4000], pool[500:4500]
    ra, rb = (setsketch_dedup.sketch(x, np.array([len(x)]))[0] for x in (a, b))
    both = setsketch_dedup.sketch(np.union1d(a, b), np.array([4500]))[0]
    assert (setsketch_dedup.merged(ra, rb) == both).all()
    near, some = setsketch_dedup.estimate([(ra > rb).sum()], [(ra < rb).sum()], [4000], [4000], 0.8)
    assert abs(near[0] - 3500 / 4500) < 0.1 and some[0]
    _, far = setsketch_dedup.estimate([125], [127], [4000], [4000], 0.8)
    assert not far[0]


# -- source divergence


ODD_DOCS = [
    (1, "The cat, the CAT and the\tdog 12 dog", "en", "a", 1.0),
    (2, "the cat the dog café Éa", "en", "b", 1.0),
    (3, "the cat dog café", "en", None, 1.0),
    (3, "cat café 日本 日本", "en", "a", 1.0),
    (4, None, "en", "c", None),
    (5, "", "de", "a", 1.0),
    (6, "der hund", None, None, 1.0),
    (7, "der hund", None, "", 1.0),
    (8, "der Hund der", "", "b", 1.0),
]


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string, source string, n double")


def rows_in_duck(df):
    con = duck("/root/testdata/sf0.001")
    con.register("held", df.select("text", "lang", "source").toArrow())
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM held")
    return con


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_terms_on_odd_rows(odd_docs, bits):
    got = sorted(tuple(r) for r in divergence_audit.audit(odd_docs, bits=bits).collect())
    want = rows_in_duck(odd_docs).execute(SOURCE_DIVERGENCE).fetchall()
    assert got == sorted(want) and any(r[2] == "term" for r in want)


def test_terms_with_collisions_on_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    a, b = (sorted(tuple(r) for r in divergence_audit.audit(docs, bits=bits).collect()) for bits in (64, 9))
    assert a == b and len(a) > 1000


def test_terms_of_nothing(odd_docs):
    assert divergence_audit.audit(odd_docs.limit(0)).count() == 0


def test_chance_is_exact(spark):
    from pyspark.sql import functions as F

    n, total, v = 3 * 10**13, 10**14 + 7, 10**6 + 3
    got = spark.range(1).select(divergence_audit.chance(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (total + v)


# -- conversations


def cheapest_by_force(kinds):
    """Least (cost, audit) of all edits of a few messages."""
    best = (10**9, "")
    initials = {"D": "", "s": "s", "u": "u", "a": "a", "x": "x"}
    legal = re.compile(r"(s?(ua)+)?")
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    options = [[("D", "", 4)] if k == "D" else [("D", "", 4), ("K", initials[k.lower()], 3 * k.isupper()), *(("R", x, 3 + 3 * k.isupper()) for x in "ua")] for k in kinds]
    for chosen in itertools.product(*options):
        for added in itertools.product(inserts, repeat=len(kinds) + 1):
            cost = sum(c for *_, c in chosen) + 3 * sum(map(len, added))
            if cost > best[0]:
                continue
            roles = "".join("".join(p) + (chosen[i][1] if i < len(kinds) else "") for i, p in enumerate(added))
            audit = "".join("I" * len(p) + (chosen[i][0] if i < len(kinds) else "") for i, p in enumerate(added))
            if legal.fullmatch(roles) and (cost, audit) < best:
                best = (cost, audit)
    return best


def least_by_strings(kinds):
    """The same for any length: whole audits are kept for every state."""
    best = {0: (0, "")}
    for k in kinds + hirschberg.END:
        after = {}
        for s, (cost, audit) in best.items():
            for (e, x), (c, letters) in hirschberg.edits(k).items():
                if e == s:
                    after[x] = min(after.get(x, (10**9, "")), (cost + c, audit + letters))
        best = after
    return best[0]


def test_cheapest_edits_of_short_conversations():
    rng = random.Random(3)
    for n in range(4):
        every = list(itertools.product("DsuaxSUA", repeat=n))
        for kinds in every if n < 3 else rng.sample(every, 40):
            cost, letters, _ = hirschberg.solve("".join(kinds) + hirschberg.END)
            assert (cost, "".join(letters)) == cheapest_by_force("".join(kinds)), kinds


def test_cheapest_edits_of_long_conversations():
    rng = random.Random(8)
    for n in (5, 17, 64, 301):
        for _ in range(30):
            kinds = "".join(rng.choice("DsuaxSUAX") for _ in range(n))
            cost, letters, _ = hirschberg.solve(kinds + hirschberg.END)
            assert (cost, "".join(letters)) == least_by_strings(kinds)


def damaged_by_force(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def report_by_force(rows):
    out = {}
    left = damaged_by_force(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, kinds, counts = set(), "", [0, 0, 0]
        for _, _, role, text in mine:
            visible = re.sub("[\\x20\\x09-\\x0D]", "", text)
            fault = 0 if not visible else 1 if (role, text) in seen else 2 if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "D" if fault in (0, 1) else kind.upper() if fault == 2 else kind
        roles = [r[2][:1] for r in mine]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(roles))
        cost, audit = least_by_strings(kinds)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text, state, at = [], "", 0
        for x in audit:
            role = "user" if state in ("", "s", "a") else "assistant"
            if x == "I":
                text.append((role, ""))
            elif x != "D":
                text.append((mine[at][2] if x == "K" else role, mine[at][3]))
            if x != "I":
                at += 1
            state = text[-1][0][:1] if text else ""
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in text).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def check_repair(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, at string, number int").repartition(7)
    original = conversation_repair.rows_of(df)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r.conv_id: tuple(r[c] for c in names) for r in conversation_repair.report(original, conversation_repair.damage(original), **sizes).collect()}
    assert got == report_by_force(rows)


def odd_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?\n", "", " \t", "well...", "Yes.", "ça va!", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            rows += [(None if c == 3 else c, rng.choice([t, t, t, None, t + 2, -t]), rng.choice(roles), rng.choice(texts) or None if rng.random() < 0.1 else f"{rng.choice(['x', 'y'])} {rng.randrange(40)}{rng.choice('.!? ')}")]
    return rows


def test_repair_on_odd_rows(spark):
    check_repair(spark, odd_rows(1, 60, 12))


def test_repair_in_segments(spark, monkeypatch):
    """Conversations of up to 400 messages in segments of 3, three a node of the tree."""
    monkeypatch.setattr(conversation_repair, "FAN_OUT", 4)
    check_repair(spark, odd_rows(2, 12, 400), max_rows=3)


def test_repair_on_conversations(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r for r in QUERIES["op13_conversation_repair"](spark, sf_small).collect()}
    want = report_by_force(rows)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {c: tuple(r[n] for n in names) for c, r in got.items()} == want


def test_repair_of_nothing(spark):
    none = conversation_repair.rows_of(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert conversation_repair.report(none, conversation_repair.damage(none)).count() == 0
