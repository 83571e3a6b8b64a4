"""Source mixing, the prefix trie and the Merkle manifest, on messy rows against brute force and on the given tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emberline.llm.merkle import manifest
from emberline.llm.prefix_trie import prefix_trie
from emberline.llm.ranks import ranked, running
from emberline.llm.source_mix import mix_sources
from oracle_check import compare, duckdb_session

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"Word{i % 977}" for i in range(30_000))


def crc(value):
    return zlib.crc32(str(value).encode())


def crc_of(column):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_source_mix", "op12_prefix_trie", "op13_merkle_manifest"])
def test_query_equals_oracle(spark, name):
    assert compare(entry.queries()[name](spark, SF), duckdb_session(SF), entry.oracle_sql()[name]) is None


# ---- places and sums

def test_ranks_of_groups_over_several_partitions(spark):
    rows = spark.range(5000, numPartitions=5).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 101).alias("v"))
    found = defaultdict(list)
    for r in ranked(rows, ["g"], [F.col("v")], "test-ranks").collect():
        found[r.g].append((r["rank"], r.v))
    for own in found.values():
        own.sort()
        assert [n for n, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for _, v in own)
    assert sum(map(len, found.values())) == 5000


def test_running_sums_over_chunks(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).alias("n"), (F.col("id") * 31 % 17).alias("v"))
    before = defaultdict(int)
    for r in sorted(running(rows, ["k"], "n", ["v"], F.sum, lambda a, b: a + b, chunk=7).collect(), key=lambda r: (r.k, r.n)):
        assert r.before_v == before[r.k]
        before[r.k] += r.v


# ---- source mix

def mixed(docs):
    return mix_sources(docs).collect()


def targets(sizes):
    """Water filling with exact fractions."""
    from fractions import Fraction
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, budget = set(), Fraction(3, 2) * sum(sizes.values())
    while True:
        level = (budget - sum(2 * sizes[s] for s in full)) / (sum(weight[s] for s in order if s not in full) or 1)
        over = {s for s in order if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def check_mix(rows, nearness):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) < 1e-6 * max(1, r.target)
    for s, words in taken.items():
        assert abs(words - want[s]) <= nearness(s), (s, words, float(want[s]))
    return taken


def test_mix_of_messy_rows(spark):
    random.seed(3)
    rows = [(i, random.choice(["a", "b", "é", "", "hot", "hot", "hot", None]), " ".join(["w"] * random.randint(0, 40)), "?", "?", "?", "?")
            for i in range(600)]
    rows += [(None, "a", None, *"????"), (None, None, "x y", *"????"), (None, None, "x y", *"????"), (7, "long", LONG, *"????"),
             (8, "long", "short one", *"????"), (9, "none", None, *"????"), (9, "none", " \n", *"????")]
    rows += [(5, "same", "one two three", *"????")] * 400  # equal rows can only be taken apart by their place
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size string, hash string, row string, rank string")
    found = mixed(docs)
    assert sorted((repr(r.doc_id), repr(r.source), r.size) for r in found) == sorted(
        (repr(i), repr(s), len(WORDS.findall(t or ""))) for i, s, t, *_ in rows)
    check_mix(found, lambda s: 30_000 if s == "long" else 3)
    assert rows_of(mix_sources(docs.repartition(7))) == rows_of(mix_sources(docs))
    assert mix_sources(docs.limit(0)).count() == 0


def test_mix_of_given_documents_comes_near_every_target(spark):
    rows, longest = mixed(spark.read.parquet(f"{SF}/documents.parquet")), defaultdict(int)
    for r in rows:
        longest[r.source] = max(longest[r.source], r.size)
    check_mix(rows, lambda s: longest[s] / 2 + 1)


# ---- prefix trie

def trie(rows):
    convs, original, new = defaultdict(list), {}, {}
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, own in convs.items():
        own.sort(key=lambda t: (t[:2], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()))
        original[c] = [t[2:] for t in own]
    for c in original:
        h = crc(c) % 4
        new[c] = original.get(c - c % 20, [])[:h] + original[c][h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(new[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()), key=repr)


def trie_of(spark, rows):
    names = "words string, depth string, turns string, rank string"
    table = spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], f"conv_id long, turn long, role string, text string, {names}")
    return rows_of(prefix_trie(table, 20, crc_of("conv_id") % 4, 3))


def test_trie_of_messy_conversations(spark):
    random.seed(4)
    rows = []
    for c in [*range(90), 2 ** 40, 2 ** 40 + 3, 139]:  # the last without a lender
        for t in range(random.choice([1, 1, 2, 3, 4, 5, 8, 9, 13])):
            rows.append((c, t, random.choice(["user", "assistant", "", None]), random.choice(["a", "b c", "", None, "  "])))
    rows += [(95, None, "user", "first"), (95, 0, "user", "second"), (95, 0, "user", "second"), (95, 0, None, "second"), (95, -3, "user", LONG)]
    rows += [(None, 0, "user", "lost"), (None, None, None, None)]
    for c in range(200, 500):  # copies of one conversation, more than are hashed at a time
        rows += [(c, 0, "user", "hello"), (c, 1, "assistant", "hello you"), (c, 2, "user", "bye"), (c, 3, "user", "bye bye")]
    random.shuffle(rows)
    assert trie_of(spark, rows) == trie(rows)


def test_trie_of_a_very_long_conversation_and_of_none(spark):
    rows = [(c, t, "user", f"turn {t % 50}" if t < 9000 + c else "own") for c in (1, 2, 3) for t in range(9000 + 2 * c)]
    assert trie_of(spark, rows) == sorted(_long_trie(rows), key=repr)
    assert trie_of(spark, []) == []


def _long_trie(rows):
    """As ``trie``, for few conversations that share one prefix: nodes by the number of turns that agree."""
    original = defaultdict(list)
    for c, t, role, text in sorted(rows):
        original[c].append((role, text))
    new = {c: own[crc(c) % 4:] for c, own in original.items()}  # conversation 0 is absent
    names = {}
    for c, turns in new.items():
        state = hashlib.sha256()
        names[c] = [state.hexdigest()]
        for role, text in turns:
            state.update(repr((role, text)).encode())
            names[c].append(state.hexdigest())
    members = defaultdict(list)
    for c, own in names.items():
        for d, name in enumerate(own):
            members[d, name].append(c)
    children, below = defaultdict(int), {}
    for c, own in names.items():
        for d in range(len(own) - 1, 0, -1):
            if min(members[d, own[d]]) == c:
                children[d - 1, own[d - 1]] += 1
    for d, name in sorted(members, reverse=True):
        m = members[d, name]
        kids = {names[c][d + 1] for c in m if len(names[c]) > d + 1}
        value = (len(m) - 1) * len(WORDS.findall(new[m[0]][d - 1][1])) if d else 0
        below[d, name] = (sum(below[d + 1, k][0] for k in kids) or (not kids) * 1, value + sum(below[d + 1, k][1] for k in kids))
    return [(min(m), d, None if not d else min(members[d - 1, names[m[0]][d - 1]]), len(m), children[d, name], *below[d, name],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(names[c]) == d + 1).encode()).hexdigest())
            for (d, name), m in members.items()]


# ---- Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def manifest_of(rows):
    def leaf(i, text, lang, source, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    low = {x: tree_of([r[2] for r in sorted(langs[x], key=lambda r: r[:3])]) for x in order}
    top = tree_of([low[x][-1][0] for x in order])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for n, x in enumerate(order):
        for k, (_, _, own, r) in enumerate(sorted(langs[x], key=lambda r: r[:3])):
            way, i = [], k
            for levels, i in ((low[x], k), (top, n)):
                for nodes in levels[:-1]:
                    way.append(("".join(nodes[i // 8 * 8:i]), "".join(nodes[i + 1:i // 8 * 8 + 8])))
                    i //= 8
            folded = own
            if r[0] is not None and crc(r[0]) % 3 == 0 and r[1] is not None:
                folded = leaf(r[0], r[1].translate(lower), *r[2:])
            for a, b in way:
                folded = sha(a + folded + b)
            out.append((r[0], own, low[x][-1][0], top[-1][0], sha("".join(a + b for a, b in way)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(spark, rows, **options):
    table = spark.createDataFrame([(*r, "?", "?", "?") for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank string, tree string")
    return rows_of(manifest(table, crc_of("doc_id") % 3 == 0, **options))


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_of_messy_rows(spark, levels):
    rows = [(i, f"Text {i} Ä", "en", "s", i) for i in range(1300)] + [(i, "Two" * (i % 3), "de", None, None) for i in range(73)]
    rows += [(1, "A", f"lang{i}", "s", 1) for i in range(70)]  # more langs than a node takes
    rows += [(3, None, None, None, None), (None, None, None, None, None), (None, "", None, "", 0), (9, LONG, "é", "s", 1)]
    rows += [(6, "A", "same", "s", 1)] * 600 + [(6, "B", "same", "s", 1), (0, "x", "", "s", 1)]
    random.seed(5)
    random.shuffle(rows)
    assert manifest_rows(spark, rows, levels=levels) == manifest_of(rows)


def test_manifest_of_one_row_and_of_none(spark):
    for rows in ([(4, "One", "en", "s", 3)], []):
        assert manifest_rows(spark, rows) == manifest_of(rows)
