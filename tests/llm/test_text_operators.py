"""Exact and near dedup, packing, decontamination, chunks, LM scores: against brute force, with hard rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakewright.llm import chunk_dedup, decontaminate, exact_dedup, lm_score, near_dedup, packing
from lakewright.llm.elias_fano import EliasFano, Trie
from lakewright.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"
BPE = tokenizer_path("byte_bpe_50k.json")


def words(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def hard(spark):
    """Null, empty, blank, repeated, tied, very long and near-equal texts, and a column with a clashing name."""
    a, b = words(1, 120), words(2, 90)
    near = [*a[:60], "changed", *a[61:]]
    texts = [
        (1, " ".join(a)), (2, "  ".join(a)), (3, " ".join(near)), (4, " ".join(b)), (4, " ".join(b)), (5, None), (6, ""), (7, " \t\n\x0b\x0c\r"), (8, "one two"), (9, "One two"),
        (10, " ".join(words(3, 30_000))), (11, "x" * 200_000), (12, "and " * 5000), (13, "<|endoftext|> as text"), (14, "ação ünïcode ß 中文 \U0001f600"), (None, "no id at all"),
        (15, " ".join([*b[:85], "other", "end", "of", "it", "now"])),
    ]
    rows = [(i, t, None if i == 3 else "en", "src", None, "clash") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3), rows


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_groups(hard):
    df, rows = hard
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), (i is not None, i or 0), i))
    got = exact_dedup.exact_groups(df, digest_all=True).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        assert r.keep_id == min(by_sha[r.text_sha256])[2]
        assert r.group_size == len(by_sha[r.text_sha256])
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == len(groups)


def test_empty_tables(spark, nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.drop_exact_copies(nothing).count() == 0
    assert near_dedup.near_groups(nothing).count() == 0
    assert packing.pack_documents(nothing, BPE).count() == 0
    assert chunk_dedup.duplicate_spans(nothing).count() == 0
    assert lm_score.scores(nothing).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.drop_contaminated(nothing, bench).count() == 0


def shingle_set(text):
    w = [x.lower() if x.isascii() else x for x in (text or "").split()]
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def components(rows):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        find(i)
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def test_near_groups(hard):
    df, rows = hard
    want = components([(i, t) for i, t, *_ in rows])
    got = near_dedup.near_groups(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)
    assert len(set(want.values())) < len(want)
    kept = near_dedup.drop_near_copies(df)
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} | {None}


def test_near_groups_of_many_copies_and_a_shared_passage(spark):
    """A large group of near copies, and documents that share a passage without being copies: large buckets of both kinds."""
    base, passage = words(5, 200), words(6, 60)
    rows = [(i, " ".join([*base[: i % 190], f"e{i}", *base[i % 190 + 1 :]])) for i in range(120)]
    rows += [(1000 + i, " ".join([*passage, *words(100 + i, 12 + i % 40)])) for i in range(150)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == components(rows)


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    for s in (0.3, 0.75, 0.95):
        shared, own = int(1000 * s), 1000 - int(1000 * s)
        x = r.integers(0, 1 << 63, shared + own, dtype=np.uint64)
        a, b = near_dedup.signature(x[: shared + own // 2]), near_dedup.signature(np.concatenate([x[:shared], x[shared + own // 2 :]]))
        assert abs((a == b).mean() - s) < 0.1


def test_tokenizer_equals_tokenizers(hard):
    from tokenizers import Tokenizer

    reference, mine = Tokenizer.from_file(BPE), packing.tokenizer(BPE)
    for _, text, *_ in hard[1]:
        text = (text or "")[:20_000]
        assert mine(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(hard):
    df, rows = hard
    got = packing.pack_documents(df, BPE).collect()
    encode = packing.tokenizer(BPE)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.append(encode(t or ""), 2).astype("<u4")
        for k, (start, n) in enumerate(packing.cut(len(ids), 1024)):
            want[i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 1024) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_two_fit_packs_everything(lengths):
    plan = packing.best_two_fit(Counter(lengths), 64)
    packed = Counter()
    for times, content in plan:
        assert times > 0
        assert sum(content) <= 64
        for n in content:
            packed[n] += times
    assert packed == Counter(lengths)
    # first-fit decreasing is never much better
    bins = []
    for n in sorted(lengths, reverse=True):
        for b in bins:
            if sum(b) + n <= 64:
                b.append(n)
                break
        else:
            bins.append([n])
    assert sum(t for t, _ in plan) <= len(bins) + 2


def test_best_two_fit_replaces_the_smallest():
    # greedy fills 6 + 3 and leaves 1; 2 + 2 instead of 3 leaves none
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


def weighted(a, b):
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both) if both else 0.0


def bag(w):
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def test_contamination_equals_brute_force(spark):
    r = random.Random(3)
    items = [(k, " ".join(words(500 + k, n))) for k, n in enumerate((15, 22, 30, 30, 59, 3, 5))] + [(90, None), (91, "")]
    rows = []
    for i in range(60):
        w = words(i, r.randrange(10, 200))
        item = items[i % 7][1].split()
        leak = [*item[: len(item) - i % 3]]
        if len(leak) > 20 and i % 4 == 0:
            leak[r.randrange(len(leak))] = "edited"
        at = r.randrange(len(w))
        rows.append((i, " ".join([*w[:at], *leak, *w[at:]]) if i % 5 else " ".join(w)))
    rows += [(100, items[4][1]), (101, None), (102, ""), (103, " ".join(items[3][1].split()[:27])), (104, (items[1][1] + " ") * 300)]
    got = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, text in rows:
        w = (text or "").lower().split()
        for k, item in items:
            v = (item or "").lower().split()
            if v and w:
                n = min(len(v), len(w))
                best = max(weighted(bag(w[s : s + n]), bag(v)) for s in range(len(w) - n + 1))
                if best >= 0.75:
                    want[i, k] = best
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert len(want) > 30


def test_multi_index_finds_all_within_radius():
    index = decontaminate.Index([(k, " ".join(words(k, 20))) for k in range(50)])
    r = np.random.default_rng(1)
    prints = index.prints[r.integers(0, 50, 400)].copy()
    for row in prints:
        flips = r.choice(128, r.integers(0, 45), replace=False)
        for f in flips:
            row[f // 16] ^= np.uint16(1 << (f % 16))
    w, i = index.within(prints)
    distance = np.bitwise_count(prints[:, None, :] ^ index.prints[None, :, :]).sum(axis=2)
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == set(zip(*[x.tolist() for x in np.nonzero(distance <= decontaminate.RADIUS)], strict=True))


def test_gear_hash_and_boundaries():
    data = " ".join(words(9, 3000)).encode()
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(chunk_dedup._GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    assert chunk_dedup.gear_hashes(data).tolist() == out
    cuts = [i + 1 for i in range(24, len(out) - 24) if out[i] < min(out[i - 24 : i]) and out[i] <= min(out[i + 1 : i + 25])]
    assert set(cuts) <= set(chunk_dedup.boundaries(data).tolist())
    shifted = set((chunk_dedup.boundaries(b"inserted words " + data) - 15).tolist())
    assert len(shifted & set(cuts)) > 0.99 * len(cuts)
    assert np.diff(chunk_dedup.boundaries(b"and " * 5000), prepend=0).max() <= chunk_dedup.MAX_CHUNK


def test_duplicate_spans_and_cut(spark, hard):
    passage = " ".join(words(77, 60))
    rows = [(i, f"{' '.join(words(200 + i, 40))}\n{passage}\n{' '.join(words(300 + i, 40))}" if i % 2 else " ".join(words(400 + i, 100))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = chunk_dedup.duplicate_spans(df).collect()
    assert {s.doc_id for s in spans} == {i for i in range(20) if i % 2}
    text = dict(rows)
    for s in spans:
        part = text[s.doc_id].encode()[s.start : s.start + s.length].decode("utf-8", "ignore")
        assert sum(part in t for t in text.values()) == 10
        assert s.first_doc_id == 1
        assert s.kept == (s.doc_id == 1)
    cut = {r.doc_id: r.text for r in chunk_dedup.cut_duplicates(df).collect()}
    assert cut[1] == text[1]
    assert all(cut[i] == text[i] for i in range(0, 20, 2))
    assert all(len(cut[i]) < len(text[i]) - 120 for i in range(3, 20, 2))
    assert chunk_dedup.cut_duplicates(hard[0]).count() == len(hard[1])
    whole = {s.doc_id for s in chunk_dedup.duplicate_spans(hard[0]).collect()}
    assert {1, 2, 3} & whole


def test_shared_passages_of_over_50_words_are_found_whole(spark):
    r, rows, passages = random.Random(5), [], []
    for k in range(300):
        short = ["".join(r.choice("abcdefghijklmnoprstuvé") for _ in range(r.randrange(2, 6))) for _ in range((51, 4, 12)[k % 3])]
        passages.append((short * 13)[:51])
        rows += [(2 * k + i, " ".join([*words(f"{k}{i}a", 60), "|", *passages[k], "|", *words(f"{k}{i}b", 60)])) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text, covered = dict(rows), {}
    for s in chunk_dedup.duplicate_spans(df).collect():
        data = text[s.doc_id].encode()
        data[s.start : s.start + s.length].decode()
        if s.doc_id % 2:
            covered.setdefault(s.doc_id, set()).update(range(s.start, s.start + s.length))
    cut = {r.doc_id: r.text for r in chunk_dedup.cut_duplicates(df).collect()}
    for k, p in enumerate(passages):
        passage, data = " ".join(p).encode(), text[2 * k + 1].encode()
        at = data.index(passage)
        assert set(range(at, at + len(passage))) <= covered.get(2 * k + 1, set()), k
        assert len(cut[2 * k + 1]) < len(text[2 * k + 1]) - len(" ".join(p)) + 1
        if k % 3 == 0:
            assert passage.decode() in cut[2 * k]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300))
def test_elias_fano_access(values):
    values = np.sort(np.array(values, np.int64))
    assert EliasFano.encode(values).access(np.arange(len(values))).tolist() == values.tolist()


def test_trie_lookup():
    r = np.random.default_rng(2)
    pairs = {(int(v), int(w)): float(p) for v, w, p in zip(r.integers(0, 40, 500), r.integers(0, 200, 500), r.uniform(1e-9, 1, 500), strict=True)}
    keys = sorted(pairs)
    v, w = (np.array(x) for x in zip(*keys, strict=True))
    trie = Trie.build(v.astype(np.uint64), w.astype(np.uint32), np.array([pairs[k] for k in keys])).mapped()
    contexts = np.arange(0, 60, dtype=np.uint64)
    asked = r.integers(0, 200, 60 * 7).astype(np.uint32)
    codes = trie.lookup(contexts, np.full(60, 7), asked)
    for k, (code, word) in enumerate(zip(codes, asked, strict=True)):
        p = pairs.get((k // 7, int(word)))
        assert (code == 0xFFFF) == (p is None)
        assert p is None or abs(int(code) / 6000 + math.log10(p)) < 1e-4
    assert Trie.build(contexts[:0], asked[:0], np.empty(0)).mapped().lookup(contexts, np.full(60, 7), asked).min() == 0xFFFF


def test_lm_scores(hard):
    df, rows = hard
    got = lm_score.scores(df).collect()
    assert len(got) == len(rows)
    tokens = [[*[w.lower() if w.isascii() else w for w in (t or "").split()], None] for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = c.total(), len(c)
    want = Counter()
    for (i, *_), t, h in zip(rows, tokens, held, strict=True):
        want[i, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 3)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    pairs = Counter(p for t, h in zip(tokens, held, strict=True) if not h for p in zip([None, *t], t))
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d, u = n1 / (n1 + 2 * n2), lm_score.UNIGRAM

    def p(x, w):
        p1 = (c[w] - d) / n if c[w] else d * v / n
        return (1 - u) * pairs[x, w] / c[x] + u * p1 if c[x] else p1

    total = Counter(round(sum(math.log10(p(x, w)) for x, w in zip([None, *t], t)) / len(t), 2) for t in tokens)
    assert Counter(round(r.score / r.n_tokens, 2) for r in got) == total
    # every context's successors sum to 1
    known = list(c)
    for x in (None, known[1], "never seen"):
        assert abs(sum(p(x, w) for w in known) + p(x, "never seen") - 1) < 1e-9


def test_lm_beats_the_base_on_held_out_text(spark, sf):
    got = [r for r in lm_score.scores(spark.read.parquet(f"{sf}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
