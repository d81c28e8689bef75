"""Training-data operators against brute force, round trips and edge cases on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import bpe, fingerprints, jaccard_join, language, licenses, main_text, mixing, shards, texts, token_files, vectors

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = [None, "", " ", "one", "A b c d", "x " * 3000, "tab\tand\x0bmore wide  two\n\nlines", "I'm they'RE <|endoftext|> 12 34!?", "\x1c!\x1d ÀÉ naïve 漢字 𝄞"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, rank string, _text string"


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi om pi".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = list(ODD)
    for _ in range(25):
        base = words(rng, rng.randrange(5, 120))
        texts.append(base)
        for _ in range(rng.randrange(4)):
            copy = base.split()
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = words(rng, 1)
            texts.append(" ".join(copy))
    passage = words(rng, 30)
    texts += [f"{words(rng, 40)} {passage}" for _ in range(12)] + [texts[10]] * 40
    return [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "a", None]), 0, "clash", "clash", "clash") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_jaccard_join_equals_brute_force(docs, rows, empty):
    sets = {r[0]: shingles(r[1]) for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_documents(docs).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    assert jaccard_join.join_documents(empty).collect() == []


def test_linked_sets_share_a_probe_key():
    rng, zero = np.random.default_rng(3), np.zeros(jaccard_join.COUNTERS, dtype=np.uint32)
    for size in [*range(1, 40), 100, 333, 2000]:
        pool = np.unique(rng.integers(0, 1 << 63, 4 * size + 8, dtype=np.uint64))
        rng.shuffle(pool)
        common = -(-3 * size // 4)
        a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:common], pool[size : size + (size - common) // 3]]))
        inter = len(np.intersect1d(a, b))
        if 4 * inter >= 3 * (len(a) + len(b) - inter):
            assert np.intersect1d(jaccard_join.probe_keys(a, zero)[0], jaccard_join.probe_keys(b, zero)[0]).size


def test_fingerprints(spark, docs, rows, empty):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs).collect()}
    order = sorted((r[0] for r in rows), reverse=True)
    text = {r[0]: r[1] or "" for r in rows}
    for k, i in enumerate(order):
        after, third = text[order[(k + 1) % len(order)]], len(text[i]) // 3
        edited = text[i][: len(text[i]) - third] + after[:third]
        assert got[i]["n_chars"] == len(text[i]) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        split = lambda t: {tuple(w[j : j + 5]) for w in [t.split()] for j in range(max(1, len(w) - 4))} if t.split() else set()
        a, b = split(text[i]), split(edited)
        if i > len(ODD) and a and b:
            assert abs(got[i]["near_edited"] - len(a & b) / len(a | b)) < 0.2
        assert 0 <= got[i]["near_next"] <= 1
    by_text = defaultdict(set)
    for i, t in text.items():
        by_text[t].add(got[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints.fingerprint_edits(empty).collect() == []
    parts = spark.createDataFrame([(1, "a b c d e f g"), (1, "c d e f g h i"), (2, None)], "g int, text string").withColumn("s", fingerprints.sketch(F.col("text")))
    merged = {r["g"]: r["s"] for r in fingerprints.merge_sketches(parts, ["g"], "s").collect()}
    assert merged[1] == spark.range(1).select(fingerprints.sketch(F.lit("a b c d e f g h i"))).first()[0] and merged[2] == []


def test_language(spark, docs, rows, empty):
    pools = {"de": "der die und nicht schule haus", "en": "the and with house school that", "fr": "le la et avec maison ecole"}
    rng = random.Random(2)
    data = [(k, " ".join(rng.choice(p.split()) for _ in range(12)), x) for k, (x, p) in enumerate([*pools.items()] * 60)]
    got = language.predict_languages(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(r["lang_pred"] == data[r["doc_id"]][2] for r in got)
    odd = {r["doc_id"]: r for r in language.predict_languages(docs).collect()}
    assert len(odd) == len(rows) and all((odd[r[0]]["lang_pred"] == "und") == (not any(c.isalpha() for c in r[1] or "")) for r in rows)
    assert language.predict_languages(empty).collect() == []


def test_token_files_equal_the_library(docs, rows, empty):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    got, start = {r["doc_id"]: r for r in token_files.index_documents(docs, path=path).collect()}, 0
    for r in sorted(rows):
        ids = [*whole.encode(r[1] or "", add_special_tokens=False).ids, 0]
        assert (got[r[0]]["start"], got[r[0]]["n_tokens"], got[r[0]]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.index_documents(empty, path=path).collect() == []


def test_a_run_of_texts_asks_for_each_chunk_once(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, codec, asked = tokenizers.Tokenizer.from_file(path), token_files.CachedTokenizer(path), []
    whole.encode_special_tokens = True
    monkeypatch.setattr(token_files, "RUN_BYTES", 4000)
    own = codec._ids_of
    codec._ids_of = lambda chunks, apart: asked.append(chunks) or own(chunks, apart)
    rng = random.Random(4)
    rows = ["".join(rng.choice(["the", " tale", "  of\n", "\t\tx", " é,", "\r\n", "\0", " “a”.", "<|endoftext|>", "\u2003b" if k % 9 == 0 else "b"]) for _ in range(rng.randrange(60))) for k in range(300)]
    rows[7:9] = [None, ""]
    for column in (pa.array(rows), pa.array(["x", *rows], pa.large_string()).slice(1)):
        at = 0
        for ids, sizes in codec.encode(column):
            for own_ids in np.split(ids, np.cumsum(sizes))[:-1]:
                assert own_ids.tolist() == whole.encode(rows[at] or "", add_special_tokens=False).ids, repr(rows[at])
                at += 1
        assert at == len(rows)
    assert len(asked) > 2 and all(len({*chunks}) == len(chunks) for chunks in asked)
    assert [*codec.encode(pa.array([], pa.string()))] == [] and [(i.tolist(), n.tolist()) for i, n in codec.encode(pa.array(["", None]))] == [([], [0, 0])]


def test_texts_in_bytes_are_cut_alike():
    rng = random.Random(5)
    rows = ["".join(rng.choice("ab \n  \n\tx\r\0é\x0b\u2003“" if k % 3 == 0 else "ab \n\n\t  é“") for _ in range(rng.randrange(14))) for k in range(5000)]
    for first, data, starts, ends in texts.byte_slices(pa.array(rows), 3000):
        begin, whole = texts.chunk_starts(data, starts, ends)
        for k, (lo, hi) in enumerate(zip(starts, ends)):
            cuts = [*begin[(begin >= lo) & (begin < hi)], hi]
            want = texts.independent_chunks(rows[first + k])
            assert (want is None) == (k in whole)
            assert [data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])] == ([rows[first + k]] if want is None else want)


def test_texts_are_cut_as_by_the_pattern(monkeypatch):
    assert {*map(chr, range(0x110000))} & {c for c in map(chr, range(0x110000)) if c.isspace()} == {*texts.ASCII_SPACE, *texts.RARE_SPACE}
    assert all(map(str.isascii, texts.RARE_ASCII)) and not any(map(str.isascii, texts.RARE_SPACE[len(texts.RARE_ASCII) :]))
    rng = random.Random(9)
    for k in range(20_000):
        t = "".join(rng.choice("ab \n  \n\tx\r\0é\x0b\u2003" if k % 3 == 0 else "ab \n\n  é") for _ in range(rng.randrange(14)))
        want = None if {*t} & {*texts.RARE_SPACE} else texts.CHUNK.findall(t)
        assert texts.independent_chunks(t) == want, repr(t)
    # Plain blanks and line breaks are cut without the pattern.
    monkeypatch.setattr(texts, "CHUNK", None)
    assert texts.independent_chunks(" a  b\n\n c\nd \n") == [" a", "  b", "\n\n c", "\nd", " \n"]


def test_byte_pairs_equal_the_library(docs, rows, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe.encoder(path, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(1)
    odd = ["".join(rng.choice("ab =' \n\t\x1c éß漢") for _ in range(n)) for n in (1, 2, 3, 40, 400) for _ in range(40)]
    odd += ["=" * 5000, "ab" * 4000, "".join(rng.choice("abcdefghij") for _ in range(6000)), "word " * 40000]
    for t in odd:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t[:80]
        assert codec.decode(ids) == t.encode()
    got = {r["doc_id"]: r for r in bpe.token_digests(bpe.encode_documents(docs, path=path, pattern=public_tokenizers.PATTERN)).collect()}
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        assert got[r[0]]["n_tokens"] == len(ids) and got[r[0]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r[0]]["decoded_sha256"] == hashlib.sha256((r[1] or "").encode()).hexdigest()
    assert bpe.encode_documents(empty, path=path, pattern=public_tokenizers.PATTERN).collect() == []


def test_license_scan(spark):
    texts = [None, "", "The MIT\nLicense and mit license.", "Licensed under the Apache License, Version 2.0.", "apache licensed", "under the GNU General Public License; general public license", "Licensed under CC BY-NC 4.0.", "mİt license"]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (got[k]["n_words"], got[k]["n_base"]) == (len(w), len(at))
        assert got[k]["first_word"] == min((i for i, _ in at), default=None) and got[k]["last_word"] == max((i for i, _ in at), default=None)
        assert got[k]["base_labels"] == ",".join(sorted({x for _, x in at}))
    assert got[6]["labels"] == "cc,cc-by-nc" and got[0]["score"] == 0.0 and got[3]["labels"] == "apache"


def test_shards(docs, rows, empty):
    got = shards.shard_documents(docs, shards=6).collect()
    total, by = defaultdict(int), defaultdict(list)
    for r in got:
        text = (rows[r["doc_id"]][1] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
        total[r["shard"]] += r["size"]
        by[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sum(total.values()) == sum(len((r[1] or "").encode()) + 8 for r in rows)
    assert shards.shard_documents(empty).collect() == []


def test_mix(docs, rows, empty):
    got = mixing.mix_documents(docs, block_words=8).collect()
    size = {r[0]: len((r[1] or "").replace(" ", "x").replace("\x1c", "x").replace("\x1d", "x").split()) for r in rows}
    taken, sizes, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    weight, capped = {"a": 3, "b": 1, None: 2}, {}
    while True:
        rest = [s for s in sizes if s not in capped]
        level = (1.5 * sum(sizes.values()) - sum(capped.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        capped |= {s: 2 * sizes[s] for s in over}
    want = {s: capped.get(s, level * weight[s]) for s in sizes}
    assert all(abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 1 for s in sizes)
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix_documents(docs.repartition(2), block_words=8).collect()))
    assert mixing.mix_documents(empty).collect() == []


def test_permutation_visits_every_index():
    for n in (1, 2, 3, 10, 257, 1000):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 77))
        assert sorted(out.tolist()) == list(range(n))


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>
<div class="cookie-notice">We use cookies</div>{}<div id="comments"><p>Nice post by a reader of it</p></div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("shell", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>"])
def test_marked_article(shell):
    body = "<h1>Head  line</h1><p>First &amp; <b>bold</b>\n text<p>Second<br>line<div class=ad>Buy</div><ul><li>one<li>two</ul><form>Send</form>"
    assert main_text.main_text(PAGE.format(shell.format(body))) == "Head line\nFirst & bold text\nSecond line\none\ntwo"


def test_unmarked_article_and_odd_pages(spark):
    long = "A long sentence of the article that goes on for a while, " * 4
    assert main_text.main_text(PAGE.format(f"<div><p>{long}</p><p>Short.</p><p>{long}</p></div>")).split("\n") == [long.strip(), "Short.", long.strip()]
    assert [main_text.main_text(x) for x in (None, "", "plain", "<p", "<!-- x")] == ["", "", "plain", "", ""]
    pages = spark.createDataFrame([(1, None, None), (2, "u", "<article>é</article>")], "page_id long, url string, html string")
    assert [tuple(r) for r in main_text.extract_pages(pages).orderBy("page_id").collect()] == [(1, None, "", 0), (2, "u", "é", 1)]


LONG = "A long sentence of the article that goes on for a while, " * 4
TEASER = "<article class=card><h3>Other</h3><p>A short teaser for another page of this site, which is not the article.</p></article>"


def test_lines_decide_with_marks_as_weight():
    whole = LONG.strip()
    # An article in plain blocks beside a marked teaser.
    links = "<ul><li><a href=x>a</a><li><a href=x>b</a><li><a href=x>c</a></ul>"
    assert main_text.main_text(f"<div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>{links}{TEASER}").startswith(f"Head\n{whole}\n{whole}")
    # Text beside a trusted mark counts if it surges by itself; short lines do not.
    assert main_text.main_text(f"<div>By me</div><div>{LONG}</div><article><p>{LONG}</p><p>End.</p><p>{LONG}</p></article><div>All rights</div>") == f"{whole}\n{whole}\nEnd.\n{whole}"
    # No line of a marked article is lost, whatever stands between.
    assert main_text.main_text(f"<article><p>{LONG}</p><aside><p>a</p><p>b</p><p>c</p><p>d</p></aside><p>End.</p></article>") == f"{whole}\nEnd."


@pytest.mark.parametrize("name, kept", [("notice-text", True), ("related-work", True), ("entry-header", True), ("notice", False), ("related-posts", False), ("share-buttons", False), ("ad-text", False), ("site-header", False)])
def test_names_inside_an_article(name, kept):
    assert main_text.main_text(f"<article><p>{LONG}</p><div class='{name}'><p>Some words.</p></div></article>") == LONG.strip() + "\nSome words." * kept


def test_given_pages_without_their_marks_give_the_same_blocks():
    pages = pytest.importorskip("pyarrow.parquet").read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    same = [main_text.main_text(p) == main_text.main_text(re.sub(r"<(/?)article\b", r"<\1div", p)) for p in pages]
    assert sum(same) >= 0.9 * len(same)


def test_vector_links_reach_the_recall(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    data = [base[k % 60] + rng.normal(size=16) * 0.08 * (k >= 60) for k in range(300)] + [base[0]] * 20
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0]]
    table = spark.createDataFrame([(k, [float(x) for x in v], "c") for k, v in enumerate(data)] + [(1000 + k, v, "c") for k, v in enumerate(odd)], "vec_id long, embedding array<double>, id string")
    got = {r["vec_id"]: r for r in vectors.link_vectors(table, block=64).collect()}
    m = np.array(data) / np.linalg.norm(data, axis=1, keepdims=True)
    near = (m @ m.T >= 0.95) & ~np.eye(len(m), dtype=bool)
    found = np.array([got[k]["n_links"] for k in range(len(m))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.9 * near.sum()
    assert all(got[1000 + k]["n_links"] == 0 and got[1000 + k]["kept"] for k in range(len(odd)))
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got.values())
    assert vectors.link_vectors(table.limit(0)).collect() == []


def linked_as_brute_force(spark, data):
    table = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vectors.link_vectors(table).collect()}
    m = data / np.linalg.norm(data, axis=1, keepdims=True)
    links = (m @ m.T >= 0.95).sum(axis=1) - 1
    return np.array([got[k] for k in range(len(data))]), links


def planted(rng, n, width, pairs):
    data = rng.normal(size=(n, width))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    step = rng.normal(size=(pairs, width))
    data[n - pairs :] = data[:pairs] + 0.27 * step / np.linalg.norm(step, axis=1, keepdims=True)
    return data


def test_vector_links_of_few_pairs_in_many_rows(spark):
    found, links = linked_as_brute_force(spark, planted(np.random.default_rng(8), 6000, 32, 60))
    assert links.sum() >= 100 and (found == links).all()


def test_vector_links_beside_a_dense_group(spark):
    rng = np.random.default_rng(9)
    data = planted(rng, 5000, 32, 100)
    dense = rng.normal(size=32) + rng.normal(size=(1000, 32)) * 1e-3
    found, links = linked_as_brute_force(spark, np.concatenate([data, dense]))
    assert (links[-1000:] >= 999).all() and links[:5000].sum() >= 180 and (found == links).all()


def test_vector_limit_is_learned_from_enough_groups(spark):
    data = planted(np.random.default_rng(10), 6000, 32, 3000)
    table = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(data)], "rep long, vector array<double>")
    assert 0 < vectors.fit_index(table, 6000).limit < 0.1
    found, links = linked_as_brute_force(spark, data)
    assert 0.99 * links.sum() <= found.sum() and (found <= links).all()


def test_mixed_blocks(docs, rows):
    blocks = mixing.mix_blocks(docs, block_words=8, shards=5).collect()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_documents(docs, block_words=8, shards=5).collect()}
    target = {r["source"]: round(r["target"]) for r in mixing.mix_documents(docs, block_words=8).collect()}
    split = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    by_source, counted = defaultdict(list), defaultdict(int)
    for b in blocks:
        by_source[b["source"]].append(b)
        assert [s["start"] for s in b["spans"]] == [sum(s["words"] for s in b["spans"][:k]) for k in range(len(b["spans"]))]
        for s in b["spans"]:
            counted[s["id"]] += s["words"]
    assert {k: n for k, n in taken.items() if n} == dict(counted)
    for source, own in by_source.items():
        stream = [w for r in sorted(rows) if r[3] == source for w in split[r[0]]]
        whole = -(-len(stream) // 8)
        passes = defaultdict(list)
        for b in sorted(own, key=lambda b: b["slot"]):
            assert b["text"].split(" ") == stream[b["block"] * 8 :][: b["take"]]
            assert b["pass"] == b["slot"] // whole
            passes[b["pass"]].append(b["block"])
        assert sum(b["take"] for b in own) == target[source]
        assert [b["slot"] for b in sorted(own, key=lambda b: b["slot"])] == list(range(len(own)))
        assert all(len(set(p)) == len(p) for p in passes.values())
        assert all(sorted(p) == list(range(whole)) for k, p in passes.items() if k < target[source] // len(stream))
    per_shard = [sum(b["shard"] == k for b in blocks) for k in range(5)]
    assert sum(per_shard) == len(blocks) and max(per_shard) - min(per_shard) <= 1 + len(by_source)
