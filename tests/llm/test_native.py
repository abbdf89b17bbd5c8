"""Quote linking and fingerprints against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from corvane.llm import fingerprints as fp
from corvane.llm import quotes
from corvane.llm.queries import QUERIES
from corvane.llm.tables import ranked

SF = "/root/testdata/sf0.001"


def test_ranked(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    got = ranked(df, [F.desc("k")], "r").collect()
    assert sorted((r.r, r.k) for r in got) == [(k + 1, 499 - k) for k in range(500)]


def edited(texts):
    keys = sorted(texts, reverse=True)
    out = {}
    for k, key in enumerate(keys):
        own, other = texts[key] or "", texts[keys[(k + 1) % len(keys)]] or ""
        half = len(own) // 2
        out[key] = own[: len(own) - half] + other[:half]
    return out


def test_fingerprint_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want = edited(texts)
    rows = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, SF).collect()}
    assert set(rows) == set(texts)
    by_text = {}
    for key, r in rows.items():
        assert r.n_chars == len(texts[key] or "")
        assert r.edited_sha256 == hashlib.sha256(want[key].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(texts[key], r.fingerprint) == r.fingerprint
    assert len({r.fingerprint for r in rows.values()}) == len(by_text)
    long = [r for r in rows.values() if r.n_chars > 800]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


def test_lone_and_null_documents(spark):
    docs = spark.createDataFrame([(3, "ab. cde")], "doc_id long, text string")
    assert [r.edited for r in fp.with_neighbours(docs).collect()] == ["ab. ab."]
    docs = spark.createDataFrame([(3, None), (2, "wxyz"), (2, "wxyz"), (-5, "😀b")], "doc_id long, text string")
    got = sorted((r.doc_id, r.edited) for r in fp.with_neighbours(docs).collect())
    assert got == [(-5, "😀"), (2, "wx😀b"), (2, "wx😀b"), (3, "")]
    assert fp.with_neighbours(docs.limit(0)).collect() == []


def test_homomorphism(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(30):
        a = [rng.choice("abcdefgh") * rng.randint(0, 3) for _ in range(rng.randint(1, 40))]
        b = [rng.choice("abcdefgh") * rng.randint(0, 3) for _ in range(rng.randint(1, 40))]
        both = a + b
        rng.shuffle(both)
        rows.append(tuple("\n".join(x) for x in (a, b, both)))
    df = spark.createDataFrame(rows, "a string, b string, c string").select(*(fp.vector(F.col(x)).alias(x) for x in "abc"))
    df = df.cache()
    assert df.filter(fp.joined(F.col("a"), F.col("b")) != F.col("c")).count() == 0
    assert df.filter(fp.without(F.col("c"), F.col("b")) != F.col("a")).count() == 0
    assert df.filter(F.size("a") != fp.LANES).count() == 0
    alike = df.select(fp.likeness(F.col("a"), F.col("a")).alias("x")).distinct().collect()
    assert [r.x for r in alike] == [1.0]


def test_likeness_follows_the_share_of_common_paragraphs(spark):
    rows = []
    for n in (8, 60, 500):
        for share in (0.0, 0.5, 0.9):
            for t in range(40):
                a = [f"{n} {t} {k}" for k in range(n)]
                rows.append((n, share, "\n".join(a), "\n".join(x if k < n * share else "other " + x for k, x in enumerate(a))))
    df = spark.createDataFrame(rows, "n int, share double, a string, b string").repartition(8)
    like = fp.likeness(fp.vector(F.col("a")), fp.vector(F.col("b")))
    got = {(r.n, r.share): r.x for r in df.groupBy("n", "share").agg(F.avg(like).alias("x")).collect()}
    for n in (8, 60, 500):
        assert got[n, 0.0] < 0.05 < 0.2 < got[n, 0.5] < got[n, 0.9] - 0.15, got


def test_likeness_of_very_long_texts(spark):
    """Half of 100,000 paragraphs replaced: a third of all paragraphs of both is common."""
    text = lambda t, cut: F.concat_ws("\n", F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda k: F.concat_ws(" ", t, F.when(k > cut, F.lit("other")), k)))
    df = spark.range(8).repartition(8).select(fp.vector(text(F.col("id"), 100_000)).alias("a"), fp.vector(text(F.col("id"), 50_000)).alias("b"))
    got = df.select(F.avg(fp.likeness(F.col("a"), F.col("b"))).alias("x")).first().x
    assert 0.2 < got < 0.45, got


def norm(x):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", x).lower().strip(" ")


def brute(rows):
    """(conv, turn) -> body, n_quoted, n_linked, reply_to, thread, depth, place."""
    parsed, units = {}, {}
    for conv, turn, _, text in rows:
        lines = []
        for x in re.split(r"\r?\n", text or ""):
            m = re.match(r"([ \t]*>)+[ \t]?", x)
            lines.append((m.group().count(">") if m else 0, x[m.end() :] if m else x))
        parsed[conv, turn] = lines
        own = "\n".join(c for n, c in lines if n == 0).strip(" ")
        units[conv, turn] = (own, {norm(p) for p in [own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]} - {""})
    out = {}
    for (conv, turn), lines in parsed.items():
        runs, last = [], 0
        for n, c in lines:
            if n and n == last:
                runs[-1][1].append(c)
            elif n:
                runs.append((n, [c]))
            last = n
        level = {}
        for n, own in runs:
            for p in {norm("\n".join(own)), *map(norm, own)} - {""}:
                level[p] = min(level.get(p, 99), n)
        votes, linked = {}, 0
        for p, n in level.items():
            origin = min((t for (c, t), (_, u) in units.items() if c == conv and p in u), default=None)
            if origin is not None and origin < turn:
                votes[n, origin] = votes.get((n, origin), 0) + 1
                linked += 1
        reply = min(votes, key=lambda v: (v[0], -votes[v], -v[1]))[1] if votes else None
        out[conv, turn] = [units[conv, turn][0], sum(n > 0 for n, _ in lines), linked, reply]
    for key in sorted(out):
        top, depth = key[1], 0
        while out[key[0], top][3] is not None:
            top, depth = out[key[0], top][3], depth + 1
        out[key] += [top, depth]
    place = {}
    for key in sorted(out, key=lambda k: (k[0], out[k][4], k[1])):
        place[key[0]] = place.get(key[0], 0) + 1
        out[key].append(place[key[0]])
    return {k: tuple(v) for k, v in out.items()}


def threads(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(6):
        texts = []
        for turn in range(rng.randint(1, 14)):
            own = "\n".join(rng.choice(["Yes  please", "no", "Common line", "", f"Point {rng.randint(0, 30)}.", "a\tb"]) for _ in range(rng.randint(0, 5)))
            if texts and rng.random() < 0.7:
                quoted = rng.choice(texts[-4:])
                marked = "\n".join((">" if x.startswith(">") else "> ") + (x.upper() if rng.random() < 0.2 else x) for x in quoted.split("\n"))
                own = rng.choice([f"{marked}\n{own}", f"{own}\r\n{marked}", f" > nobody wrote this\n{own}"])
            texts.append(own)
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), own if rng.random() < 0.95 else None))
    return rows


def test_quotes(spark):
    linked = 0
    for seed in (1, 2):
        rows = threads(seed)
        turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, body string")
        got = quotes.link(turns).collect()
        want = brute(rows)
        assert len(got) == len(rows)
        assert {(r.conv_id, r.turn): (r.body, r.n_quoted, r.n_linked, r.reply_to, r.thread, r.depth, r.place) for r in got} == want
        linked += sum(v[2] for v in want.values())
        assert max(v[5] for v in want.values()) > 1
    assert linked > 20


def test_quotes_of_nothing_and_odd_rows(spark):
    kind = "conv_id long, turn int, role string, text string"
    assert quotes.link(spark.createDataFrame([], kind)).collect() == []
    rows = [(1, 0, "u", "hi"), (1, 0, "u", "hi"), (1, 1, "a", "> hi\nyes"), (None, 0, "u", "x"), (1, None, "u", "> hi"), (None, None, None, None)]
    got = quotes.link(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == 6
    assert [(r.reply_to, r.body) for r in got if r.turn == 1] == [(0, "yes")]


def test_given_conversations(spark):
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op4_quotes"](spark, SF).collect()
    assert {(r.conv_id, r.turn): (r.body, r.n_quoted, r.n_linked, r.reply_to, r.thread, r.depth, r.place) for r in got} == brute(rows)
