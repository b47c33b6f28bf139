"""Each operator: its contract by brute force, and null, empty, long, tied, repeated and clashing rows."""

import base64
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from fleetlens.llm import decontam, forest, graph, langid, licenses, mixing, passages, ranking, simhash, textstats, urlfilter, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, fp long, size long, host string, features string, component string"


def docs_of(spark, texts, langs=None, sources=None, ids=None):
    """Documents with columns whose names the operators use themselves."""
    n = len(texts)
    ids, langs, sources = ids or list(range(n)), langs or ["en"] * n, sources or ["s"] * n
    made = [(i, t, l, s, None, 1, 2, "h", "f", "c") for i, t, l, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(made, DOC)


def prose(draw, n, words=400):
    return " ".join(f"w{k}" for k in draw.integers(0, words, n))


AWKWARD = [None, "", " \n\t ", "one", "A b", "x " * 30_000, "same text here", "same text here", "été naïve 漢字 ½", "a\x00b"]


# graph --------------------------------------------------------------------------------------------------------------


def test_components(spark):
    draw = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, None), (7, 7)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    assert got == {x: root(x) for x in parent}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# 8 ------------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [words[k : k + 3] for k in range(len(words) - 2)] if len(words) > 3 else [words]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_simhash(spark):
    draw = np.random.default_rng(1)
    base = [prose(draw, 200) for _ in range(12)]
    texts = AWKWARD + base + [b.replace("w7 ", "w8 ", 1).upper() for b in base[:8]] + [base[0]] * 3
    ids = [*range(100, 100 + len(texts) - 1), None]
    got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs_of(spark, texts, ids=ids)).collect()]
    prints = [plain_fingerprint(t) for t in texts]
    assert sorted((i or -1, f) for i, f, _ in got) == sorted((i or -1, f) for i, f in zip(ids, prints))
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(texts)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 3:
            parent[root(b)] = root(a)
    least = defaultdict(lambda: 10**9)
    for k, i in enumerate(ids):
        if i is not None:
            least[root(k)] = min(least[root(k)], i)
    assert Counter(got) == Counter((i, f, least[root(k)]) for k, (i, f) in enumerate(zip(ids, prints)))
    assert simhash.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0
    stays = simhash.one_of_each(docs_of(spark, texts, ids=ids))
    assert stays.columns == docs_of(spark, texts).columns and stays.where("doc_id is null").count() == 1


def test_one_of_each_judges_rows_by_id_and_text(spark):
    draw = np.random.default_rng(11)
    own = [prose(draw, 120, 10**6) for _ in range(6)]
    near = own[0].split()
    near[60] = "changed"
    far = own[0].split()
    far[10], far[50], far[90] = "one", "two", "three"  # 15 of 116 shingles: similarity 0.77
    texts = [own[0], own[1], own[2], own[3], own[3].upper(), " ".join(near), " ".join(far), own[4], own[4], own[5], "", None, " ", "a b", "a b"]
    ids = [1, 1, 2, 3, 3, 4, 5, 6, 6, None, 7, 8, 9, 10, 11]
    docs = docs_of(spark, texts, ids=ids).repartition(3)
    kept = simhash.one_of_each(docs)
    want = [(1, own[0]), (1, own[1]), (2, own[2]), (3, min(own[3], own[3].upper(), key=lambda t: hashlib.md5(t.encode()).hexdigest())), (5, texts[6]), (6, own[4]), (None, own[5]), (7, ""), (10, "a b")]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, want)) and kept.columns == docs.columns
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_near_copies_against_brute_force(spark):
    """Of the pairs at similarity 0.8 or more, at least 95 % are in one group; pairs below are linked by none."""
    draw = np.random.default_rng(12)
    texts = []
    for _ in range(40):
        words = prose(draw, int(draw.integers(60, 300)), 10**6).split()
        texts.append(" ".join(words))
        for _ in range(3):
            edited = list(words)
            for at in draw.choice(len(words), max(1, len(words) * int(draw.integers(1, 4)) // 100), replace=False):
                edited[at] = f"x{draw.integers(10**6)}"
            texts.append(" ".join(edited))
    stays = {r.id for r in simhash.near_copies(docs_of(spark, texts)).where("stays").collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    close = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    left = [(a, b) for a, b in close if a in stays and b in stays]
    assert len(close) > 100 and len(left) <= 0.05 * len(close)
    lone = set(range(len(texts))) - {x for p in close for x in p}
    assert lone <= stays


def test_crowded_groups_are_numbered_in_parts(spark):
    from fleetlens.llm import groups

    rows = spark.createDataFrame([("a", k) for k in range(500)] + [("b", 7), ("b", 9), ("c", 1)], "k string, m long")
    hot = groups.crowded(rows, "k")
    assert [r.k for r in hot.collect()] == ["a"]
    got = groups.numbered(rows, "k", "m", hot).collect()
    assert Counter(r.k for r in got) == {"a": 500, "b": 2} and all(r.least == (0 if r.k == "a" else 7) for r in got)
    assert {(r.m, r.nth) for r in got if r.k == "b"} == {(7, 1), (9, 2)}
    of = [r for r in got if r.k == "a"]
    assert len({r.nth for r in of}) == 500 and {r.last for r in of} == {max(r.nth for r in of)}
    plain = groups.numbered(rows, "k", "m", hot.limit(0)).where("k = 'a'").collect()
    assert all(r.nth == r.m + 1 and r.last is None for r in plain)


@pytest.mark.parametrize("hot", [2000, 1])
def test_links_are_complete(spark, hot):
    draw = np.random.default_rng(0)
    values = set()
    for x in draw.integers(-(2**63), 2**63 - 1, 60, dtype=np.int64):
        values.add(int(x))
        for _ in range(6):
            y = int(x) % 2**64
            for b in draw.choice(64, draw.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            values.add((y + 2**63) % 2**64 - 2**63)
    values = sorted(values)
    want = {(a, b) for a, b in itertools.combinations(values, 2) if bin((a ^ b) % 2**64).count("1") <= 3}
    found = [tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), hot=hot).collect()]
    assert len(found) == len(set(found)) and set(found) == want and want


# 6 ------------------------------------------------------------------------------------------------------------------


def test_compact_windows_are_the_trees_wide_nodes():
    draw = np.random.default_rng(3)
    for t in range(150):
        n, width = int(draw.integers(1, 50)), int(draw.integers(1, 12))
        v = draw.integers(0, [4, 1000][t % 2], n).astype(np.uint64)
        want = set()
        for c in range(n):
            left, right = c, c
            while left > 0 and v[left - 1] > v[c]:
                left -= 1
            while right < n - 1 and v[right + 1] >= v[c]:
                right += 1
            if right - left + 1 >= width:
                want.add((left, c, right))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(v, width)))) == want


def test_passages(spark):
    draw = np.random.default_rng(2)
    own = [prose(draw, 150, 10**6) for _ in range(9)]
    shared, other = prose(draw, 52, 10**6), prose(draw, 60, 10**6)
    put = other.split()
    edited = " ".join(put[:30] + ["new"] + put[30:])  # a word put in
    texts = AWKWARD + [
        own[0], f"{own[1]} {shared} {own[2]}", f"{shared.upper()}\n{own[3]}", f"{own[4]} {shared}", f"{own[5]} {other}", f"{edited} {own[6]}",
        f"{own[7]} {' '.join(shared.split()[:45])}", own[8], own[8],
    ]
    ids = list(range(len(texts)))
    got = {r.doc_id: r for r in passages.classes(docs_of(spark, texts)).collect()}
    assert sorted(got) == ids
    classed = {k: r.class_id for k, r in got.items() if r.class_id != k}
    assert classed == {12: 11, 13: 11, 15: 14, 18: 17}
    assert got[12].n_repeated == 52 and got[13].n_spans == 1 and got[15].n_repeated >= 50 and got[18].n_repeated == 150 and got[11].n_repeated == 0
    clash = docs_of(spark, texts).withColumn("ranges", F.lit(1))
    assert passages.without_repeats(clash).columns == clash.columns
    kept = {r.doc_id: r for r in passages.without_repeats(docs_of(spark, texts, ids=[None if k == 3 else k for k in ids])).collect()}
    assert kept[12].text == own[3] and kept[11].text == texts[11] and 18 not in kept and kept[13].text == own[4] + " " and kept[1].text == ""
    assert kept[12].n_chars == len(own[3]) and kept[11].n_chars is None and kept[None].text == "one"
    assert passages.classes(docs_of(spark, texts).limit(0)).count() == 0 and passages.without_repeats(docs_of(spark, texts).limit(0)).count() == 0


def test_shared_passages_agree_with_brute_force(spark):
    draw = np.random.default_rng(9)
    pieces = [prose(draw, 55, 10**6) for _ in range(6)]
    texts = [" ".join([prose(draw, int(draw.integers(5, 80)), 10**6), *draw.choice(pieces, int(draw.integers(0, 3))).tolist(), prose(draw, 30, 10**6)]) for _ in range(60)]
    runs = defaultdict(set)
    for k, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - 49):
            runs[tuple(w[i : i + 50])].add(k)
    linked = {pair for ks in runs.values() for pair in itertools.combinations(sorted(ks), 2)}
    got = {r.doc_id: r.class_id for r in passages.classes(docs_of(spark, texts)).collect()}
    assert linked and all(got[a] == got[b] for a, b in linked)
    assert all(got[k] == k for k in range(60) if not any(k in p for p in linked))


def words_of(draw, n):
    return draw.integers(1, 1 << 62, n).astype(np.uint64)


def covered(found):
    return {k for first, last, _, _ in found for k in range(first, last + 1)}


def test_a_passage_does_not_hide_another_of_the_same_pair():
    draw = np.random.default_rng(31)
    long, short, edited = words_of(draw, 80), words_of(draw, 50), words_of(draw, 60)
    between, ends = words_of(draw, 40), words_of(draw, 11)
    # on one shift: a long passage, and one of fifty words with a stray match eleven tokens past its end
    stray = words_of(draw, 5)
    a = passages.tokens(np.concatenate([long, between, short, ends[:10], stray, words_of(draw, 30)]))
    b = passages.tokens(np.concatenate([long, words_of(draw, 40), short, words_of(draw, 10), stray, words_of(draw, 30)]))
    got = covered(passages.shared_passages(a, b, 46))
    assert set(range(76)) | set(range(120, 166)) <= got
    # a word put in: the halves are too short to be aligned
    put = np.concatenate([edited[:30], words_of(draw, 1), edited[30:]])
    a = passages.tokens(np.concatenate([long, between, put, words_of(draw, 30)]))
    b = passages.tokens(np.concatenate([long, words_of(draw, 40), edited, words_of(draw, 30)]))
    assert set(range(76)) | set(range(120, 177)) <= covered(passages.shared_passages(a, b, 46))


def test_every_place_of_a_passage_is_found():
    draw = np.random.default_rng(32)
    shared, tail = words_of(draw, 60), words_of(draw, 36)
    # the later places run into words that the other text has elsewhere
    a = passages.tokens(np.concatenate([shared, words_of(draw, 70), shared, tail, words_of(draw, 70), tail, shared]))
    b = passages.tokens(np.concatenate([shared, words_of(draw, 70), tail]))
    assert {*range(56), *range(130, 186), *range(332, 388)} <= covered(passages.shared_passages(a, b, 46))


def test_shifts_agree_with_brute_force():
    draw = np.random.default_rng(33)
    for n, m, words in ((30, 50, 3), (200, 90, 40), (5, 5, 1), (60, 60, 10**6)):
        a, b = draw.integers(0, words, n).astype(np.uint64), draw.integers(0, words, m).astype(np.uint64)
        counts = Counter(i - j for i in range(n) for j in range(m) if a[i] == b[j])
        assert sorted(passages._shifts(a, b, 3).tolist()) == sorted(s for s, k in counts.items() if k >= 3)


def test_a_document_behind_others_of_its_signature_is_reached(spark):
    draw = np.random.default_rng(34)

    def sigs(text):
        values = passages.tokens(passages.WordHashes().of(text.encode()))
        return set(passages.signatures(np.append(values, np.uint64(0)), np.array([len(values)]), 46)[0].tolist())

    while True:  # a passage whose signatures two documents have too that hold only 45 of its words
        passage = prose(draw, 50, 10**6)
        most = " ".join(passage.split()[:45])
        texts = [f"{prose(draw, 60, 10**6)} {p} {prose(draw, 60, 10**6)}" for p in (most, passage, most, passage)]
        of = [sigs(t) for t in texts]
        if of[1] & of[3] and of[1] & of[3] <= of[0] & of[2]:
            break
    got = {r.doc_id: r for r in passages.classes(docs_of(spark, texts)).collect()}
    assert [got[k].class_id for k in range(4)] == [0, 1, 2, 1] and got[3].n_repeated >= 50


def test_nearly_every_passage_with_a_changed_word_is_a_candidate():
    draw = np.random.default_rng(35)

    def sigs(words):
        values = passages.tokens(np.concatenate([words_of(draw, 60), words, words_of(draw, 60)]))
        return set(passages.signatures(np.append(values, np.uint64(0)), np.array([len(values)]), 46)[0].tolist())

    met = 0
    for _ in range(500):
        passage = words_of(draw, 50)
        edited = passage.copy()
        edited[draw.integers(5, 45)] ^= np.uint64(1)
        met += not sigs(passage).isdisjoint(sigs(edited))
    assert met >= 490


# 1 ------------------------------------------------------------------------------------------------------------------


def test_decontamination(spark):
    item = "If Anna walks 12 km in 3 hours then how far does Anna walk in 7 hours each day?"
    changed = "If Bob walks 15 km in 4 hours then how far does Bob walk in 9 hours each day?"
    broken = "If Bob walks 15 km in 4 hours then how far does Carl walk in 9 hours each day?"
    texts = AWKWARD + [f"Some words before. {item} And after.", f"Before. {changed}", broken, " ".join(item.split()[:9]), changed.replace("15 km", "1,500.5 km")]
    bench = spark.createDataFrame([(1, item, "x"), (2, "too short", "x"), (None, item, "x"), (3, None, "x"), (4, "", "x")], "item_id long, text string, n_windows string")
    ids = [*range(len(texts) - 1), None]
    found = {r.doc_id: r for r in decontam.leaks(docs_of(spark, texts, ids=ids), bench).collect()}
    assert {k: (r.item_id, r.n_windows, r.n_item_windows, r.n_changed) for k, r in found.items()} == {10: (1, 15, 15, 0), 11: (1, 15, 15, 4), None: (1, 15, 15, 4)}
    again = decontam.leaks(docs_of(spark, texts, ids=ids), bench, broadcast_windows=0)
    assert {r.doc_id for r in again.collect()} == set(found)
    kept = decontam.cleaned(docs_of(spark, texts, ids=ids), bench)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts) - 1)) - {10, 11} and kept.columns == docs_of(spark, texts).columns
    assert decontam.leaks(docs_of(spark, texts).limit(0), bench).count() == 0 and decontam.leaks(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_slots_that_share_a_value_change_apart(spark):
    item = "Tim has 5 apples in a bag and buys 5 pears at the shop so how many pieces does he own?"
    texts = [item.replace("5 apples", "6 apples").replace("5 pears", "9 pears"), item.replace("5", "6"), item.replace("bag", "box").replace("shop", "inn")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r.n_changed for r in decontam.leaks(docs_of(spark, texts), bench).collect()}
    assert found == {0: 1, 1: 1}


def test_short_items_and_runs_of_numbers(spark):
    numbers = " ".join(map(str, range(100, 140)))
    items = ["Tallest fjord mouse?", "12 7 9", numbers, "One two three four plain words here."]
    texts = ["See the tallest fjord mouse here", "tallest fjord mice", "12 7 9 10", "12 7 8", " ".join(map(str, range(500, 900))), f"a {numbers} b", "x one two three four plain words here"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.n_windows == r.n_item_windows) for r in decontam.leaks(docs_of(spark, texts), bench).collect()}
    assert found == {(0, 0, True), (2, 1, True), (5, 2, True), (6, 3, True)}


def test_a_phrase_that_all_share_fetches_no_candidates(spark, monkeypatch):
    draw = np.random.default_rng(38)
    phrase = "what is the sum of all the parts that"
    letters = lambda n: " ".join("".join(draw.choice(list("abcdefgh"), 7)) for _ in range(n))
    bench = spark.createDataFrame([(k, f"{phrase} {letters(24)}") for k in range(300)], "item_id long, text string")
    made = {}
    monkeypatch.setattr(decontam, "keep", lambda df, name, keep=decontam.keep: made.setdefault(name, keep(df, name)))
    leak = bench.where("item_id = 7").first().text
    docs = docs_of(spark, [f"{letters(20)} {phrase} {letters(20)}" for _ in range(100)] + [leak])
    assert [(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()] == [(100, 7)]
    assert made["candidates"].count() == 1 and made["met"].count() <= 30


def plain_leaks(texts, items):
    """By the definition: every pair, without hashes, prefixes or joins."""
    units = decontam.UNITS.split("|")

    def parsed(text):
        text = re.sub(r"([0-9])([A-Za-z%])", r"\1 \2", re.sub(r"([0-9])[.,]([0-9])", r"\1\2", text))
        marked = re.sub(r"""[A-Z](?<=[^.!?:\n"' ] .)[^\x00-\x60\x7B-\x7F]+""", "ⓝ", text).lower()
        split = lambda t: [w for w in re.split(decontam.SEPARATORS, t) if w]
        kinds = split(re.sub("[0-9]+", "⓪", marked))
        kinds = ["ⓤ" if k and kinds[k - 1] == "⓪" and w in units else w for k, w in enumerate(kinds)]
        return split(text.lower()), kinds

    out = set()
    for d, t in enumerate(texts):
        words, kinds = parsed(t)
        for i, own in enumerate(map(parsed, items)):
            wins = {k: tuple(own[1][k : k + 5]) for k in range(len(own[1]) - 4) if set(own[1][k : k + 5]) - {"⓪", "ⓝ", "ⓤ"}}
            good = set()
            for shift in range(-len(own[1]), len(kinds)):
                at = [k for k, w in wins.items() if k + shift >= 0 and tuple(kinds[k + shift : k + shift + 5]) == w]
                names = {(own[0][p], words[p + shift]) for k in at for p in range(k, k + 5) if own[1][p] == "ⓝ"}
                if len(names) == len({a for a, _ in names}):
                    good |= {wins[k] for k in at}
            if wins and len(good) >= 0.8 * len(set(wins.values())) - 1e-9:
                out.add((d, i, len(good)))
    return out


def test_leaks_agree_with_brute_force(spark):
    draw = np.random.default_rng(39)
    say = lambda: " ".join(str(draw.choice(["Anna", "Bob", "7", "12 km", "3.5", "walks", "so", "then", "far", "and", "how", "is", "it."])) for _ in range(14))
    items = [say() for _ in range(25)]
    swap = {"Anna": "Carl", "7": "8", "12 km": "40 miles", "3.5": "1,000"}
    texts = []
    for k, item in enumerate(items):
        for a, b in list(swap.items())[: k % 5]:
            item = item.replace(a, b)
        texts.append(f"{say()} {item} {say()}" if k % 3 else f"{item.replace('walks', 'runs', 1)} {say()}")
    got = {(r.doc_id, r.item_id, r.n_windows) for r in decontam.leaks(docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == plain_leaks(texts, items) and len(got) >= 15


# 2 ------------------------------------------------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    html = [None, "", "<p>a</p>", "<p>a</p>", "é" * 10, "<p>b</p>\r\n\r\nWARC/1.1\r\n", "<p>a</p>", "x" * 300_000] + [f"<html><body>{'word ' * 50}{k}</body></html>" for k in range(60)]
    ids = [5, 4, 9, 8, 7, 6, 9, 3, *range(10, 70)]
    urls = ["http://a/%0A", None, "u\r\nv", *["http://x/"] * 65]
    pages = spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in zip(ids, urls, html)], "page_id long, url string, html string, payload string, bytes long").repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    by_payload = defaultdict(list)
    for i, h in zip(ids, html):
        by_payload[(h or "").encode()].append(i)
    want = []
    for (i, u, h) in zip(ids, urls, html):
        data, least = (h or "").encode(), min(by_payload[(h or "").encode()])
        want.append((i, u, "response" if i == least else "revisit", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), None if i == least else least, data if i == least else None))
    assert Counter((*r[:6], r[6] and bytes(r[6]) if r[6] is not None else None) for r in map(tuple, got)) == Counter(want)
    archives = sorted(tmp_path.glob("w/*.warc.zst"))
    assert archives and not list(tmp_path.glob("w/part-*.txt"))
    assert all((first := a.read_bytes())[:4] == warc.DICTIONARY_MAGIC and zstandard.FRAME_HEADER in first for a in archives)
    warc.write_archives(pages, str(tmp_path / "cut"), archive_bytes=2_000)
    assert Counter(map(tuple, warc.read_archives(spark, str(tmp_path / "cut")).drop("payload").collect())) == Counter(tuple(r)[:6] for r in got)
    sizes = [a.stat().st_size for a in tmp_path.glob("cut/*.warc.zst")]
    assert len(sizes) > len(archives) and max(sizes) <= 2_000 + 8
    warc.write_archives(pages, str(tmp_path / "big"), min_revisit_bytes=10**6)
    assert {r.record_type for r in warc.read_archives(spark, str(tmp_path / "big")).collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None, "a"), (None, None, "a"), (3, None, "a")], "page_id long, url string, html string")
    assert Counter((r.page_id, r.record_type) for r in warc.round_trip(nulls).collect()) == {(None, "revisit"): 2, (3, "response"): 1}


# 3 ------------------------------------------------------------------------------------------------------------------


def test_mixing(spark):
    draw = np.random.default_rng(4)
    texts = AWKWARD + ["w " * int(n) for n in draw.integers(0, 400, 300)]
    sources = [[None, "a", "b", "B", "é", "tiny"][int(k)] for k in draw.choice(6, len(texts), p=[0.1, 0.1, 0.4, 0.2, 0.18, 0.02])]
    ids = [*range(len(texts) - 2), None, 3]
    got = mixing.mix(docs_of(spark, texts, sources=sources, ids=ids), range_rows=7).collect()
    sizes = [len(WORD.findall(t or "")) for t in texts]
    assert Counter((r.doc_id, r.size) for r in got) == Counter(zip(ids, sizes))
    total = defaultdict(int)
    for s, n in zip(sources, sizes):
        total[s] += n
    order = sorted((s for s in total if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, list(order), float(sum(sizes))
    while True:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share >= 3 * total[s]]
        if not over:
            target |= {s: weight[s] * share for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            free.remove(s)
    by = {total[s]: s for s in total}
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - target[by[r.source_size]]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[by[r.source_size]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in total)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs_of(spark, texts, sources=sources, ids=ids).repartition(5)).collect()))
    assert mixing.mix(docs_of(spark, texts).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs_of(spark, [None, ""])).collect()] == [0, 0]


# 4 ------------------------------------------------------------------------------------------------------------------


def test_licenses(spark):
    texts = AWKWARD + [
        "Released UNDER the MIT\nLicense. Under-the-mit license", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "ccby nc xcc by nc", "cc by ncé",
        "This work is licensed under the GNU General Public License, version 3.", "word " * 5000 + "all rights reserved", "rights all " + "word " * 400 + "reserved",
    ]
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    for k, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        hits = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in hits]
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(hits), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in hits})) and 0 <= r.score <= 1
        # every block of every template, without any filter
        met = set()
        for number, (label, text) in enumerate(licenses.TEMPLATES):
            own = licenses.fold(text.encode())
            for at in range(0, max(1, len(words)), len(own)):
                block = {w.encode() for w in words[at : at + 2 * len(own)]}
                share = len(block & set(own)) / len(set(own))
                if share >= 0.8 - 1e-12 and (at == 0 or at < len(words)):
                    met.add((number, label, at, share))
        assert {tuple(m) for m in r.met} == met
        labels = set(filter(None, r.labels.split(",")))
        assert {label for _, label in hits} <= labels <= {label for _, label in hits} | {m[1] for m in met}
        most = max((m[3] for m in met), default=0)
        assert r.score == (1 if hits else most) and {m[1] for m in met if m[3] == most} <= labels
    assert got[12].labels == "cc-by-nc" and got[15].labels == "gpl-3" and got[16].labels == "proprietary" and got[17].labels == ""
    assert licenses.scan(docs_of(spark, texts).limit(0)).count() == 0


def test_notices_wrapped_over_lines(spark):
    draw = np.random.default_rng(36)
    texts, want = [], []
    for label, text in licenses.TEMPLATES:
        words = text.split()
        lines = "\n# ".join(" ".join(words[k : k + 4]) for k in range(0, len(words), 4))
        texts.append(f"{prose(draw, int(draw.integers(0, 90)))}\n{lines}\n{prose(draw, 60)}")
        want.append(label)
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert all(want[k] in got[k].labels.split(",") for k in range(len(texts)))


def test_blocks_above_the_threshold_are_met_without_any_word(spark):
    draw = np.random.default_rng(37)
    texts, want = [], []
    for number, (label, text) in enumerate(licenses.TEMPLATES):
        own = licenses.fold(text.encode())
        tokens = sorted(set(own))
        for lost in tokens if len(tokens) < 30 else draw.choice(tokens, 12, replace=False).tolist():
            if (len(tokens) - 1) / len(tokens) >= 0.8:
                texts.append(prose(draw, int(draw.integers(0, 50))) + " " + b" ".join(w for w in own if w != lost).decode() + " " + prose(draw, 50))
                want.append(number)
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert all(n in {m.template for m in got[k].met} and got[k].labels for k, n in enumerate(want)) and len(want) > 150


# 5 and 10 -----------------------------------------------------------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)]


def test_statistics():
    draw = np.random.default_rng(6)
    texts = AWKWARD + [" ".join(draw.choice(["a", "b", "cé", "d\n", "#$"], int(n))) for n in draw.integers(0, 80, 60)] + [prose(draw, 9000, 8000) + " " + prose(np.random.default_rng(6), 50)]
    texts.append(texts[-1] + " " + texts[-1][:400])
    for t in texts:
        assert textstats.measure(t.encode() if t is not None else None)[0] == plain_counts(t)


@pytest.fixture(scope="module")
def labelled(spark):
    draw = np.random.default_rng(8)
    good = [prose(draw, 60).replace(" w1", ". W1") for _ in range(120)]
    bad = [" | ".join(prose(draw, 60).split()) for _ in range(30)] + [" ".join(w + "###" for w in prose(draw, 60).split()) for _ in range(30)]
    texts = AWKWARD + good + bad
    marks = [None] * len(AWKWARD) + [1] * len(good) + [0] * len(bad)
    labels = spark.createDataFrame([(k, q, "t") for k, q in enumerate(marks)] + [(11, 1, "t"), (12, 0, "t"), (None, 1, "t"), (9999, 0, "t")], "doc_id long, quality int, text string")
    return texts, marks, labels


def test_ranking(spark, labelled):
    texts, marks, labels = labelled
    got = {r.doc_id: r for r in ranking.quality_scores(docs_of(spark, texts), labels).collect()}
    assert sorted(got) == list(range(len(texts)))
    for k, r in got.items():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
    held = [(got[k].predicted, q) for k, q in enumerate(marks) if q is not None and got[k].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    moved = labels.withColumn("quality", F.when(textstats.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in ranking.quality_scores(docs_of(spark, texts, langs=["xx"] * len(texts)), moved).collect()} == {k: r.score for k, r in got.items()}
    assert {r.score for r in ranking.quality_scores(docs_of(spark, texts), labels.limit(0)).collect()} == {0.5}
    assert ranking.quality_scores(docs_of(spark, texts).limit(0), labels).count() == 0


def test_forest(spark, labelled):
    texts, marks, labels = labelled
    got = {r.doc_id: r for r in forest.judged(docs_of(spark, texts), labels).collect()}
    for k, t in enumerate(texts):
        n, chars, symbols, dup, repeats = plain_counts(t)
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n) and not (r.base_failed and r.kept)
    assert all(got[k].kept for k, q in enumerate(marks) if q == 1) and not any(got[k].kept for k, q in enumerate(marks) if q == 0)
    plain = forest.judged(docs_of(spark, texts), labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in plain) and forest.judged(docs_of(spark, texts).limit(0), labels).count() == 0


def test_ranking_agrees_with_a_plain_fit(spark, labelled):
    """Weights at which the loss over the pairs has no slope, and scores by the quantiles of the training scores."""
    texts, marks, labels = labelled
    docs = docs_of(spark, texts)
    stats = textstats.measured(docs)
    x, y = textstats.labelled_sample(stats, labels, 1000, train_only=True)
    x = x[:, textstats.COLUMNS]
    model = ranking.fit(x, y)
    z = np.clip((x - np.median(x, axis=0)) / np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1), -8, 8)
    good, bad, draw = np.flatnonzero(y == 1), np.flatnonzero(y == 0), np.random.default_rng(7)
    n = min(ranking.PAIRS, len(good) * len(bad))
    d = z[draw.choice(good, n)] - z[draw.choice(bad, n)]

    def loss(w):
        return float(np.logaddexp(0, -(d @ w)).mean() + 5e-4 * w @ w)

    w = model.weights
    for k in range(len(w)):
        step = np.zeros(len(w))
        step[k] = 1e-3
        assert loss(w) <= loss(w + step) + 1e-12 and loss(w) <= loss(w - step) + 1e-12
    held = {r.doc_id: np.array(r.features)[textstats.COLUMNS] for r in stats.collect()}
    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1)
    for r in ranking.quality_scores(docs, labels, train_rows=1000).collect():
        raw = sum(min(8, max(-8, (f - c) / s)) * w for f, c, s, w in zip(held[r.doc_id], np.median(x, axis=0), scale, model.weights))
        below = [k for k, knot in enumerate(model.knots) if knot <= raw]
        at = below[-1] if below else 0
        want = model.levels[at]
        if below and at + 1 < len(model.knots):
            want += (model.levels[at + 1] - want) * (raw - model.knots[at]) / (model.knots[at + 1] - model.knots[at])
        assert abs(r.score - want) < 1e-6 and r.predicted == (r.score >= 0.7)


def test_forest_agrees_with_plain_walks(spark, labelled):
    """Anomalies by walking every tree for every document, and the threshold by trying every value."""
    texts, marks, labels = labelled
    draw = np.random.default_rng(18)
    texts, marks = [*texts, *(prose(draw, int(draw.integers(40, 90))) for _ in range(300))], [*marks, *[None] * 300]
    docs = docs_of(spark, texts)
    stats = textstats.measured(docs)
    order = stats.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)), "doc_id").collect()
    x = np.array([r.features for r in order])[:, textstats.COLUMNS]
    trees = forest.grown(x).trees
    mean_search = lambda n: 0 if n < 2 else 2 * (np.log(max(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n
    typical = mean_search(min(forest.SUBSAMPLE, len(x)))

    def walk(tree, row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.child[node] + (row[tree.feature[node]] > tree.split[node])
        return tree.length[node]

    plain = {r.doc_id: 2 ** -(np.mean([walk(t, row) for t in trees]) / typical) for r, row in zip(order, x)}
    got = {r.doc_id: r for r in forest.judged(docs, labels, 10_000).collect()}
    assert all(abs(got[k].anomaly - a) < 1e-9 for k, a in plain.items())
    known = [(plain[k], q) for k, q in enumerate(marks) if q is not None and k not in (11, 12)] + [(plain[11], 1)]
    n_good, n_bad = (sum(q == v for _, q in known) for v in (1, 0))
    shares = {t: (sum(a >= t and q == 1 for a, q in known) / n_good, sum(a >= t and q == 0 for a, q in known) / n_bad) for t, _ in known}
    allowed = {t: f - l for t, (l, f) in shares.items() if l <= forest.MOST_LOST}
    cut = min((t for t in allowed if allowed[t] > max(allowed.values()) - 1e-12), default=np.inf)
    assert all(r.kept == (not r.base_failed and plain[k] < cut - 1e-12) for k, r in got.items())


def test_the_threshold_counts_every_labelled_row(spark, labelled):
    """Against trying every value, with ties, and whatever number of rows the trees are drawn from."""
    draw = np.random.default_rng(4)
    values, marks = np.round(draw.uniform(0.3, 0.7, 3000), 3), draw.integers(0, 2, 3000)
    values[marks == 0] += 0.25
    values[:2], marks[:2] = 1.0, 1
    scored = spark.createDataFrame(list(zip(values.tolist(), marks.tolist())), "anomaly double, quality long")
    good, bad, tried = np.sort(values[marks == 1]), np.sort(values[marks == 0]), np.unique(values)
    lost, found = 1 - np.searchsorted(good, tried) / len(good), 1 - np.searchsorted(bad, tried) / len(bad)
    allowed = np.flatnonzero(lost <= 0.003)
    assert forest.threshold(scored) == tried[allowed[np.argmax((found - lost)[allowed])]]
    assert forest.threshold(scored.where("quality = 1")) == np.inf == forest.threshold(scored.limit(0))
    texts, marks, labels = labelled
    few = {r.doc_id: r for r in forest.judged(docs_of(spark, texts), labels, 10_000, train_rows=3).collect()}
    assert few == {r.doc_id: r for r in forest.judged(docs_of(spark, texts), labels, 10_000).collect()}


# 7 ------------------------------------------------------------------------------------------------------------------


def plain_language(counts, text, longest=langid.LONGEST_GRAM):
    """Word by word: log frequencies, else the mean over known n-grams of the longest length that has any."""
    langs = sorted(counts)
    grams = [
        {l: Counter(g for w, k in counts[l].items() for g in langid.Model._cut(w, n) * k) for l in langs} for n in range(1, longest + 1)
    ]

    def logs(table, x):
        seen = set().union(*table.values())
        return np.array([np.log((table[l].get(x, 0) + 0.5) / (sum(table[l].values()) + 0.5 * len(seen))) for l in langs]) if x in seen else None

    total, words = np.zeros(len(langs)), ["".join(c for c in w if c.isalpha()) for w in langid.WORD.findall((text or "").lower())]
    words = [w for w in words if w]
    for w in words:
        own = logs(counts, w)
        for n in range(longest, 0, -1):
            if own is None:
                rows = [r for g in langid.Model._cut(w, n) if (r := logs(grams[n - 1], g)) is not None]
                own = np.mean(rows, axis=0) if rows else None
        total += 0 if own is None else own
    if not words:
        return "und", 0.0
    best = int(np.argmax(total))
    return langs[best], 1 / np.exp(total - total[best]).sum()


def test_language_agrees_with_a_plain_scorer(spark):
    draw = np.random.default_rng(17)
    make = lambda parts, n: " ".join("".join(draw.choice(parts, 2)) for _ in range(n))
    parts = {"aa": ["ka", "lo", "mi", "ré"], "bb": ["ka", "lo", "tz", "lö"], "cc": ["mi", "ко", "lö"]}
    langs = [["aa", "bb", "cc"][k % 3] for k in range(60)]
    texts = [make(parts[l], int(draw.integers(1, 9))) for l in langs] + ["kalo zzqx ², tzko", "qqq", None, "12", "Éa ка_lo"]
    docs = docs_of(spark, texts, langs=[*langs, *["aa"] * 5])
    counts = defaultdict(Counter)
    for k, (t, l) in enumerate(zip(texts, [*langs, *["aa"] * 5])):
        if t is not None and zlib.crc32(str(k).encode()) % 4 != 2:
            counts[l].update(langid.WORD.findall(t.lower()))
    counts = {l: Counter({w: n for w, n in c.items() if n >= 2}) for l, c in counts.items()}
    got = {r.doc_id: r for r in langid.predictions(docs, langid.train(docs)).collect()}
    for k, t in enumerate(texts):
        want, score = plain_language(counts, t)
        assert abs(got[k].score - score) < 1e-9 and (got[k].lang_pred == want or abs(score - 0.5) < 1e-9), t


def test_vocabulary_is_cut_at_a_count():
    assert langid._cut([(5, 2), (4, 3), (1, 9)], 5) == 4 and langid._cut([(5, 2), (4, 3), (1, 9)], 4) == 5 and langid._cut([(5, 2)], 1) > 5



def test_language(spark):
    draw = np.random.default_rng(7)
    make = lambda parts: " ".join("".join(draw.choice(parts, 3)) for _ in range(int(draw.integers(1, 60))))
    parts = {"aa": ["ka", "lo", "mi", "ré"], "bb": ["sch", "ung", "tz", "lö"], "cc": ["ция", "ко", "ми"]}
    texts, langs = list(AWKWARD), [None] * len(AWKWARD)
    for k in range(240):
        lang = ["aa", "bb", "cc"][k % 3]
        texts.append(make(parts[lang]))
        langs.append(None if k % 20 == 0 else lang)
    docs = docs_of(spark, texts, langs=langs)
    model = langid.train(docs, least=1)
    got = {r.doc_id: r for r in langid.predictions(docs, model).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
    held = [(got[k].lang_pred, ["aa", "bb", "cc"][(k - len(AWKWARD)) % 3]) for k in range(len(AWKWARD), len(texts)) if got[k].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    assert langid.Scorer(model).predict("kalomikalomi")[0] == "aa" and langid.Scorer(model, remembered=0).predict("schungtz schungtzung")[0] == "bb"
    assert langid.predictions(docs.limit(0), model).count() == 0
    nothing = langid.train(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in langid.predictions(docs, nothing).collect()} == {("und", 0.0)}
    kept = langid.identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.lang_pred != "und" and r.score >= 0.5}


# 9 ------------------------------------------------------------------------------------------------------------------


def test_urls(spark):
    base = [urlfilter.Rule("||com/en/", "block"), urlfilter.Rule("||example.com/en/7", "allow"), urlfilter.Rule("||org/", "block")]
    extra = [urlfilter.Rule("^casino^", "block"), urlfilter.Rule("casino*free", "allow"), urlfilter.Rule("/ADS/", "block"), urlfilter.Rule("a*b", "allow")]
    urls = [
        None, "", "no scheme", "http://", "http://COM/en/", "https://a.Example.com/en/70?x", "https://xexample.com/en/70", "https://a.com/EN/", "http://com?/en/", "ftp://x://com/en/",
        "http://casino.net/", "http://my-casino/free", "http://casinos.net", "http://u.org/a#b", "http://u.org:80/", "http://x/ADS/", "http://x/ads/1", "http://é.com/en/", "http://org\n/",
        "http://" + "a" * 50_000 + ".com/en/",
    ]
    pages = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(urls)], "page_id long, url string, host string, path string")
    for per_pass in (100, 1, 3):
        got = {r.page_id: r for r in urlfilter.judge(pages, base, extra, per_pass).collect()}
        for k, u in enumerate(urls):
            rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
            fits = [r for r in base if (host == (h := r.name.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r.name.split("/", 1)[1])]
            best = max(fits, key=lambda r: len(r.name), default=None)
            low = (host + path).lower()
            others = [r for r in extra if re.search(r.regex(), low, re.S)]
            verdict = best.verdict if best else max(others, key=lambda r: len(r.pattern)).verdict if others else "allow"
            assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, best and best.name, verdict), u
    assert urlfilter.judge(pages.limit(0), base, extra).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, [], []).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token():
    rule = urlfilter.Rule("||example.com/en/7", "allow")
    assert rule.tokens() == {"example", "com", "en"}
    assert list(urlfilter.filed([rule], {"com": 9, "example": 2, "en": 5})) == ["example"] and list(urlfilter.filed([urlfilter.Rule("a*b", "block")], {})) == [""]


# ids ----------------------------------------------------------------------------------------------------------------


def test_null_and_repeated_ids_keep_their_rows(spark):
    draw = np.random.default_rng(21)
    texts = [prose(draw, 80) for _ in range(12)] + ["", None, "all rights reserved"]
    ids = [None, None, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8, None, 9, 9]
    docs = docs_of(spark, texts, ids=ids)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (5, 0), (None, 1), (4, 1), (4, 0)], "doc_id long, quality int")
    found = {
        "4": licenses.scan(docs), "5": ranking.quality_scores(docs, labels), "6": passages.classes(docs),
        "7": langid.predictions(docs, langid.train(docs, least=1)), "10": forest.judged(docs, labels, 100),
    }
    for name, df in found.items():
        assert Counter(r.doc_id for r in df.collect()) == Counter(ids), name
    held = {"5": found["5"], "7": found["7"]}
    assert all(not r.held_out for df in held.values() for r in df.where("doc_id is null").collect())
    assert {r.class_id for r in found["6"].where("doc_id is null").collect()} == {None}


def test_repeated_ids_are_one_document_for_leaks(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away again"
    words = item.split()
    docs = docs_of(spark, [" ".join(words[:8]), " ".join(words[4:]), item, "x"], ids=[1, 1, None, None])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.n_windows) for r in decontam.leaks(docs, bench).collect()} == {(1, 9), (None, 9)}


def test_null_and_repeated_pages(spark):
    rows = [(None, "http://a.com/en/1"), (None, None), (5, "http://b.net/de/"), (5, "http://b.net/de/"), (6, "http://x.org/spam")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    base, extra = [urlfilter.Rule("||com/en/", "block")], [urlfilter.Rule("^spam^", "block")]
    got = Counter((r.page_id, r.rule, r.verdict) for r in urlfilter.judge(pages, base, extra).collect())
    assert got == {(None, "com/en/", "block"): 1, (None, None, "allow"): 1, (5, None, "allow"): 2, (6, None, "block"): 1}
