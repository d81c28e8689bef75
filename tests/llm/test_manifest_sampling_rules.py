"""Merkle manifest, importance resampling and host rules against brute force on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.llm import host_rules, importance, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, n_words long, refused string, _from string"
WORDS = "alpha Beta gamma DELTA eps naïve 漢字 x9 a-b und# $5 | zeta eta theta".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [None, "", " \t\n", "one", "-", "ÀÉ 漢 𝄞", prose(rng, 20_000), "a b c d e f g h " * 5, "line one\nline one\n\n \nline one\nother", "x\x0by\x0cz\rw"]
    texts += [prose(rng, rng.randrange(1, 90)) for _ in range(190)]
    passage = prose(rng, 25)
    texts += [f"{passage} {prose(rng, 9)} {passage}" for _ in range(10)]
    ids = [*range(0, 130), *[None] * 5, *[77] * 9, -5, -(1 << 63), (1 << 63) - 1, 1 << 40, (1 << 40) + 3, *range(1 << 20, (1 << 20) + 56)]
    langs = ["en", "de", None, "", "-", "é", "lonely"]
    out = []
    for k, t in enumerate(texts):
        lang = "lonely" if k == 3 else langs[0] if k % 3 == 0 else rng.choice(langs[:6])
        out.append((ids[k % len(ids)], t, lang, rng.choice(["a", "b", "a", None]), rng.choice([0, 5, None, (1 << 63) - 1]), *["clash"] * 2, 7, "clash", "clash"))
    return out + [out[40]] * 30 + [out[1]] * 3


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, at):
    for nodes in levels[:-1]:
        run = nodes[at // 2 * 2 : at // 2 * 2 + 2]
        yield at % 2, [x for k, x in enumerate(run) if k != at % 2]
        at //= 2


def manifest_by_hand(rows):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        start = sha("".join(map(field, (doc_id, source, lang, n_chars + 1, text)))) if hit else leaf
        trees[lang].append((-(1 << 63) if doc_id is None else doc_id, leaf, start, doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: tree_levels([r[1] for r in sorted(trees[x], key=lambda r: r[:3])]) for x in names}
    crown = tree_levels([built[x][-1][0] for x in names])
    out = []
    for place, x in enumerate(names):
        for at, (_, leaf, node, doc_id) in enumerate(sorted(trees[x], key=lambda r: r[:3])):
            steps = [*siblings(built[x], at), *siblings(crown, place)]
            for right, others in steps:
                node = sha("".join([*others, node] if right else [node, *others]))
            root = crown[-1][0]
            out.append((str(doc_id), leaf, built[x][-1][0], root, sha("".join(o for _, others in steps for o in others)), node, node == root))
    return sorted(out)


@pytest.mark.parametrize("block_rows", [merkle.TIE_BLOCK_ROWS, 4])
def test_manifest(docs, rows, block_rows):
    got = merkle.manifest(docs, tie_block_rows=block_rows).collect()
    want = manifest_by_hand(rows)
    assert sorted((str(r["doc_id"]), *r[1:]) for r in got)[0][0] == want[0][0]
    # Rows equal in all fields may change places, which changes their proofs and no other row's.
    twins = {leaf for leaf, n in Counter(w[1] for w in want).items() if n > 1}
    plain = lambda x: x if x[1] not in twins else (*x[:4], "", *x[5:])
    assert sorted(plain((str(r["doc_id"]), *r[1:])) for r in got) == sorted(map(plain, want))
    assert Counter(r["proof_sha256"] for r in got) == Counter(w[4] for w in want)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_one_row_and_none(spark, docs):
    one = spark.createDataFrame([(3, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    row = merkle.manifest(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == sha("")
    empty = merkle.manifest(docs.limit(0))
    assert empty.count() == 0 and empty.columns == merkle.manifest(one).columns


def test_one_changed_row_changes_the_root(docs):
    root = lambda x: merkle.manifest(x).first()["root"]
    same = docs.repartition(7)
    assert root(docs) == root(same)
    assert root(docs) != root(docs.withColumn("n_chars", F.when(F.col("doc_id") == 12, 99).otherwise(F.col("n_chars"))))


def test_directory_levels_and_places(spark):
    rng = random.Random(2)
    ids = sorted({rng.choice([rng.randrange(-300, 300), rng.randrange(-(1 << 63), 1 << 63), rng.randrange(1 << 30)]) for _ in range(900)})
    rows = [("=a" if k % 3 else "=b", i, f"{k:064x}", k) for k, i in enumerate(ids)]
    table = spark.createDataFrame(rows, "tree string, id long, leaf string, row long")
    want = {}
    for tree in ("=a", "=b"):
        for at, i in enumerate(sorted(r[1] for r in rows if r[0] == tree)):
            want[tree, i] = at
    assert {(r["tree"], r["id"]): r["at"] for r in merkle.leaf_places(table).collect()} == want


def lowered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, fewest, most):
    w = lowered(text)
    return [" ".join(w[k : k + n]) for n in range(fewest, most + 1) for k in range(len(w) - n + 1)]


def resampled_by_hand(rows, target, fewest, most, buckets, seed, least, percent):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    found = [[bucket(x) for x in runs(r[1], fewest, most)] for r in rows]
    s, t = Counter(b for f in found for b in f), Counter(bucket(x) for text in target for x in runs(text, fewest, most))
    total = (s.total() + buckets, t.total() + buckets)
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * total[0] / ((s[b] + 1.0) * total[1]))) for b in range(buckets)}
    out = []
    for r, f in zip(rows, found):
        h = int(sha(f"{seed}:{'' if r[0] is None else r[0]}")[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(lowered(r[1])) >= least])
    drawn = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(drawn[: len(drawn) * percent // 100], 1):
        r[4] = place
    return sorted(map(str, (r[:5] for r in out)))


@pytest.mark.parametrize("fewest, most, percent", [(1, 1, 10), (1, 3, 40), (2, 2, 100)])
def test_resample(spark, docs, rows, fewest, most, percent):
    target = ["Alpha3 gamma7 und gamma7", None, "", "x9 naïve 漢字5 " * 40]
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs, wanted, fewest=fewest, most=most, percent=percent, buckets=500)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(list(r)) for r in got.collect()) == resampled_by_hand(rows, target, fewest, most, 500, 2024, 20, percent)


def test_resample_of_nothing(spark, docs):
    wanted = spark.createDataFrame([], "text string")
    assert importance.resample(docs.limit(0), wanted).count() == 0
    assert importance.resample(docs, wanted).filter("rank IS NOT NULL").count() > 0


def test_pieces_hold_each_run_once():
    text = prose(random.Random(4), 4000).encode()
    whole = importance.run_counts(text, 3)
    joined = Counter()
    for piece in importance.text_pieces(text, 3, limit=100):
        joined.update(m.group() for m in importance.run_pattern(3).finditer(piece, overlapped=True))
    assert joined == whole and whole.total() == len(lowered(text.decode())) - 2


def measured_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k : k + 8])].append(k)
    covered = {k + j for starts in at.values() if len(starts) > 1 for k in starts for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n_symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def test_measures_and_base_verdict(docs, rows):
    got = host_rules.judge(docs, limit=1.0).collect()
    want = []
    for r in rows:
        n, chars, symbols, dup, rep, _ = measured_by_hand(r[1])
        failed = n < 20 or 100 * rep > 30 * n
        want.append(str([r[0], n, chars, symbols, dup, rep, failed, False, not failed]))
    assert sorted(str(list(r)) for r in got) == sorted(want)
    assert any(r["n_repeat_words"] for r in got) and host_rules.judge(docs.limit(0)).count() == 0


def test_hosts_are_shrunk_and_refused(spark):
    good, bad = " ".join(f"w{k}" for k in range(30)), "few words"
    plan = {"clean": (400, 4), "mixed": (300, 60), "spam": (200, 190), None: (50, 5), "tiny": (1, 1), "pair": (2, 2)}
    rows = [(k, bad if k < failed else good, host) for host, (n, failed) in plan.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    measured = host_rules.measures(docs, text_col="text", keep=[F.col("source")])
    verdicts = {r["host"]: r for r in host_rules.host_verdicts(measured, host_col="source").collect()}
    n, k = sum(v[0] for v in plan.values()), sum(v[1] for v in plan.values())
    mean = k / n
    hosts = len(plan)
    between = sum(b * b / a for a, b in plan.values()) - n * mean * mean - (hosts - 1) * mean * (1 - mean)
    strength = mean * (1 - mean) / (between / (n - sum(a * a for a, _ in plan.values()) / n - (hosts - 1))) - 1
    strength = min(max(strength, 1), n)
    for host, (a, b) in plan.items():
        assert verdicts[host]["n_docs"] == a and verdicts[host]["failed_any"] == b
        assert verdicts[host]["rate_any"] == pytest.approx((b + mean * strength) / (a + strength))
    # One failing document does not condemn its host as surely as 190 of 200.
    assert verdicts["tiny"]["rate_any"] < verdicts["pair"]["rate_any"] < verdicts["spam"]["rate_any"]
    assert verdicts["spam"]["refused"] and not verdicts["clean"]["refused"] and not verdicts[None]["refused"]
    told = host_rules.judge(docs)
    assert told.filter("kept").count() == 396 + 240 + 45
    assert told.filter("host_refused").count() == 200 + sum(plan[h][0] for h in ("tiny", "pair") if verdicts[h]["refused"])


def test_one_host_alone_gets_the_mean(spark):
    docs = spark.createDataFrame([(k, "few" if k < 6 else "w " * 10 + " ".join(map(str, range(20))), "only") for k in range(10)], "doc_id long, text string, source string")
    row = host_rules.host_verdicts(host_rules.measures(docs, text_col="text", keep=[F.col("source")]), host_col="source").first()
    assert row["rate_any"] == pytest.approx(row["failed_any"] / 10)


def test_many_small_hosts_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(host_rules, "BROADCAST_ROWS", 3)
    good = " ".join(f"w{k}" for k in range(30))
    rows = [(k, good if k % 5 else "few", f"h{min(k, 60)}" if k % 2 else None) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = {(r["doc_id"], r["host_refused"], r["kept"]) for r in host_rules.judge(docs).collect()}
    monkeypatch.undo()
    assert few == {(r["doc_id"], r["host_refused"], r["kept"]) for r in host_rules.judge(docs).collect()} and len(few) == 200


def test_rules_stay_inside_the_jvm(docs):
    plan = host_rules.judge(docs)._jdf.queryExecution().toString() + host_rules.measures(docs, text_col="text", keep=[])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
