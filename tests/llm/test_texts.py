"""Chats, licenses, repeated passages and benchmark items against brute force."""

import random
import re
from collections import defaultdict

import duckdb
import pytest

from quayledger.llm import chat, decontaminate, licenses, suffixes
from tests.llm.conftest import SF, odd_rows


def brute_chats(rows, part):
    convs = defaultdict(set)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].add((-1 if t is None else t, r or "", x or ""))
    lists = {c: sorted(s) for c, s in convs.items()}
    kept = [c for c, s in lists.items() if not any(len(o) > len(s) and o[: len(s)] == s or o == s and d < c for d, o in lists.items())]
    out = []
    for c in kept:
        parts = defaultdict(list)
        for t, r, x in lists[c]:
            parts[t // part].append(f"<|im_start|>{r}\n{x}<|im_end|>\n")
        out += [(c, p, len(s), "".join(s)) for p, s in parts.items()]
    return sorted(out)


@pytest.mark.parametrize("part", [2, 64])
def test_chats(spark, part):
    rng = random.Random(part)
    rows = []
    for c in range(60):
        base = rng.randrange(6)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {base if t < 3 else rng.randrange(2)} {t}") for t in range(rng.randrange(1, 8))]
    rows += [(None, 0, "user", "lost"), (70, None, None, None), (71, 0, "user", "a"), (71, 0, "user", "a"), (71, 0, "user", "b"), (72, 0, "user", "a"), (73, -5, "system", ""), (74, 10**6, "user", "far")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, part long, x long")
    assert sorted(tuple(r) for r in chat.chat_texts(df, part).collect()) == brute_chats(rows, part)
    assert chat.chat_texts(df.limit(0)).collect() == []


@pytest.mark.parametrize("turn", [0, None])
def test_chats_with_turns_of_one_number(spark, turn):
    rng, rows = random.Random(11), []
    for c in range(0, 120, 2):
        role, *texts = rng.sample(["user", "tool"], 1) + sorted(f"{c} {rng.randrange(10**6)}" for _ in range(3))
        added = texts.pop(rng.randrange(3))
        rows += [(c, turn, role, x) for x in texts] + [(c + 1, turn, role, x) for x in [*texts, added]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in chat.chat_texts(df).collect()) == brute_chats(rows, 64)


def test_chats_of_the_table_are_those_of_the_sql(spark):
    duckdb.sql(f"create or replace view conversations as select * from '{SF}/conversations.parquet'")
    assert sorted(tuple(r) for r in chat.chat_texts(spark.read.parquet(f"{SF}/conversations.parquet")).collect()) == sorted(map(tuple, duckdb.sql(chat.CHAT_SQL).fetchall()))


def brute_phrases(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, odd):
        want = sorted((str(r["doc_id"]), *map(str, brute_phrases(r["text"]))) for r in df.collect())
        got = licenses.scan(df).collect()
        assert sorted((str(r["doc_id"]), *(str(r[c]) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))) for r in got) == want
        assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert licenses.scan(none).collect() == []


def test_licenses_of_the_table_are_those_of_the_sql(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF}/documents.parquet'")
    rel = duckdb.sql(licenses.scan_sql())
    got = licenses.scan(spark.read.parquet(f"{SF}/documents.parquet")).select(*rel.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rel.fetchall()))


def test_license_texts_with_edits(spark):
    words = licenses.TEMPLATES["mit-text"].split()
    edited = [w for k, w in enumerate(words) if k not in (20, 45)]
    edited.insert(30, "really")
    rows = [(1, "intro " + " ".join(edited) + " outro"), (2, " ".join(words[: len(words) // 2])), (3, licenses.TEMPLATES["apache-notice"]), (4, " ".join(sorted(words)))]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit-text", 2: "", 3: "apache,apache-notice", 4: ""}


def brute_repeats(rows):
    docs, at = [(d, (t or "").encode().split()) for d, t in rows if d is not None], defaultdict(set)
    for d, w in docs:
        for k in range(len(w) - 49):
            at[tuple(w[k : k + 50])].add(d)
    cover, later = defaultdict(set), defaultdict(set)
    for d, w in docs:
        for k in range(len(w) - 49):
            holders = at[tuple(w[k : k + 50])]
            if len(holders) > 1:
                cover[d].update(range(k, k + 50))
            if min(holders) < d:
                later[d].update(range(k, k + 50))
    return cover, later


def spans(df):
    cover, later = defaultdict(set), defaultdict(set)
    for r in df.collect():
        cover[r["doc_id"]].update(range(r["start"], r["start"] + r["words"]))
        if not r["kept"]:
            later[r["doc_id"]].update(range(r["start"], r["start"] + r["words"]))
    return cover, later


def passages():
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(50_000)}"
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 140)]
    rows = []
    for k in range(120):
        text = []
        for p in rng.sample(range(5), rng.randrange(3)):
            text += [word() for _ in range(rng.randrange(40))] + shared[p]
        rows.append((rng.randrange(-500, 10**6), " ".join(text + [word() for _ in range(rng.randrange(60))])))
    return rows + [(2_000_000 + k, rows[3][1]) for k in range(4)] + [(3_000_000, rows[5][1] + " tail")]


def test_repeats(spark, ws, none):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spans(suffixes.repeats(df.repartition(5), ws)) == brute_repeats(rows)
    assert suffixes.repeats(none, ws).collect() == []


def test_repeats_of_the_table_and_odd_rows(spark, odd, ws):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert spans(suffixes.repeats(docs, ws)) == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert spans(suffixes.repeats(odd, ws)) == brute_repeats([r[:2] for r in odd_rows()])


def test_segments_of_one_class_are_joined_by_their_ends(monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 3)
    around = b"\1" * 4 * suffixes.AROUND
    rows = [{"key": 1, "right": around, "left": around, "doc_id": d, "place": 30} for d in range(10)]
    kinds = suffixes.pa.schema([("key", suffixes.pa.int64()), ("right", suffixes.pa.binary()), ("left", suffixes.pa.binary()), ("doc_id", suffixes.pa.int64()), ("place", suffixes.pa.int32())])
    first = [r for b in suffixes.compared(suffixes.pa.Table.from_pylist(rows, kinds).to_batches()) for r in b.to_pylist()]
    assert {r["doc_id"] for r in first if r["kept"] is False} == {1, 2, 4, 5, 7, 8}
    ends = sorted({(r["key"], r["right"], r["left"], r["doc_id"], r["place"]) for r in first if r["start"] is None})
    again = suffixes.pa.Table.from_pylist([dict(zip(kinds.names, e)) for e in ends], kinds)
    monkeypatch.setattr(suffixes, "SEGMENT", 20_000)
    second = [r for b in suffixes.compared(again.to_batches()) for r in b.to_pylist()]
    assert {r["doc_id"] for r in first + second if r["kept"] is False} == set(range(1, 10))


def test_cut_repeats_leaves_each_passage_once(spark, odd, ws):
    rows = sorted(dict(passages()).items())
    df = spark.createDataFrame([(d, t, len(t), "c") for d, t in rows], "doc_id long, text string, n_chars long, cut string")
    got = {r["doc_id"]: r for r in suffixes.cut_repeats(df, ws).collect()}
    _, later = brute_repeats(rows)
    for d, t in rows:
        left = [w for k, w in enumerate(t.split()) if k not in later[d]]
        assert (got[d]["text"].split() == left and got[d]["n_chars"] == len(got[d]["text"])) if d in got else not left
    again = brute_repeats([(d, r["text"]) for d, r in got.items()])[1]
    assert not any(again.values())
    assert suffixes.cut_repeats(odd, ws).columns == odd.columns


def least_edits(item, words):
    row = [0] * (len(words) + 1)
    for k, w in enumerate(item, 1):
        new = [k]
        for j, v in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return min(row)


def test_leaks(spark, odd, none, ws):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    benchmark = {r["item_id"]: words(r["text"]) for r in items.collect()}
    want = set()
    for r in docs.collect():
        own = words(r["text"])
        for i, item in benchmark.items():
            if len(set(own) & set(item)) * 1.25 >= len(set(item)) * 0.8 and least_edits(item, own) <= decontaminate.edits(len(item)):
                want.add((r["doc_id"], i))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()} == want
    several = decontaminate.leaks(docs, items, block_chars=2000)
    assert {(r["doc_id"], r["item_id"]) for r in several.collect()} == want
    odd_items = spark.createDataFrame([(1, None), (2, ""), (None, "a row without an id"), (3, "Plain text, of one document with several words"), (4, "word")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(odd, odd_items).collect()}
    assert found == {(1, 3), (2, 3), (-13, 3), (10, 4)}
    kept = decontaminate.without_leaks(odd, odd_items, ws)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in odd_rows()} - {1, 2, -13, 10}
    assert decontaminate.leaks(none, items).collect() == [] and decontaminate.leaks(odd, odd_items.limit(0)).collect() == []


@pytest.mark.parametrize(("share", "recall"), [(0.1, 0.97), (0.2, 0.9)])
def test_recall_of_edited_items(share, recall):
    rng = random.Random(2)
    vocabulary = [f"x{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 80)))) for k in range(150)]
    index = decontaminate.Items([(i, t.encode()) for i, t in items])
    texts = []
    for _, t in items:
        w = t.split()
        for _ in range(decontaminate.edits(len(w), 1 - share)):
            p = rng.randrange(len(w))
            w[p : p + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
        texts.append(" ".join([*rng.choices(vocabulary, k=30), *w, *rng.choices(vocabulary, k=30)]).encode())
    found = {(t, i) for t, i, *_ in index.matches(texts)}
    assert sum((k, k) in found for k in range(len(items))) >= recall * len(items)


def behind_frequent_text(frequent, seed):
    """Pairs of documents that share 60 - frequent words and the frequent text after them, among documents that have the latter alone."""
    rng = random.Random(seed)
    word = lambda: f"u{rng.randrange(10**6)}"
    text = [word() for _ in range(frequent)]
    rows = []
    for k in range(60):
        own = [word() for _ in range(60 - frequent)]
        rows += [[word() for _ in range(10)] + own + text + [word() for _ in range(30)] for _ in range(2)]
    rows += [[word() for _ in range(30)] + text + [word() for _ in range(30)] for _ in range(400)]
    return [(d, " ".join(w)) for d, w in zip(rng.sample(range(10**6), len(rows)), rows)]


@pytest.mark.parametrize("frequent", [32, 40, 48])
def test_short_runs_before_frequent_text(spark, ws, frequent):
    rows = behind_frequent_text(frequent, frequent)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert spans(suffixes.repeats(df, ws)) == brute_repeats(rows)


def test_a_class_in_many_parts(spark, ws):
    rng = random.Random(4)
    words = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    frequent, before, after = words(36), [words(20) for _ in range(6)], [words(20) for _ in range(6)]
    rows = [(d, " ".join(words(10) + rng.choice([*before, words(20)]) + frequent + rng.choice([*after, words(20)]) + words(10))) for d in rng.sample(range(10**6), 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = spans(suffixes.repeats(df, ws))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_repeats(rows)


def test_passages_of_one_class_across_a_segment_edge():
    kinds = suffixes.pa.schema([("key", suffixes.pa.int64()), ("right", suffixes.pa.binary()), ("left", suffixes.pa.binary()), ("doc_id", suffixes.pa.int64()), ("place", suffixes.pa.int32())])
    around = lambda *w: b"".join(x.to_bytes(4, "big") for x in [*w, *range(1000 + w[-1], 1000 + w[-1] + suffixes.AROUND - len(w))])
    own = list(range(1, 25))
    parts = [[(5, 1), (33, 2)], [(50, 3), (17, 4), (60, 5), (9, 6), (1, None)]]
    found = []
    for part in parts:
        rows = [{"key": 1, "right": around(100 + (k or 7)), "left": around(*own) if k else around(99), "doc_id": d, "place": 30} for d, k in part]
        found += [r for b in suffixes.compared(suffixes.pa.Table.from_pylist(rows, kinds).to_batches()) for r in b.to_pylist()]
    assert {r["doc_id"] for r in found if r["kept"] is False} == {33, 50, 17, 60}
    sent = defaultdict(set)
    for r in found:
        if r["kept"] is None and r["start"] is not None:
            sent[r["key"], r["start"]].add(r["doc_id"])
    assert {5, 9} in sent.values()


def test_rows_of_one_id_keep_their_own_passages(spark, ws):
    rng = random.Random(6)
    words = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    text, passage = words(80), words(60)
    own = [*words(100), *passage, *words(20)]
    rows = [(1, " ".join(text)), (14, " ".join(text)), (14, " ".join(own)), (14, " ".join(own)), (3, " ".join([*words(5), *passage, *words(5)])), (15, None), (15, " ".join(passage))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spans(suffixes.repeats(df, ws)) == brute_repeats(rows)
    got = sorted((r["doc_id"], r["text"] or "") for r in suffixes.cut_repeats(df, ws).collect())
    assert got == sorted([rows[0], (14, " ".join([*own[:100], *own[160:]])), (14, " ".join([*own[:100], *own[160:]])), rows[4], (15, "")])


def test_one_word_again_and_again_in_an_open_class_is_few_rows():
    kinds = suffixes.pa.schema([("key", suffixes.pa.int64()), ("right", suffixes.pa.binary()), ("left", suffixes.pa.binary()), ("doc_id", suffixes.pa.int64()), ("place", suffixes.pa.int32())])
    around = b"\1" * 4 * suffixes.AROUND
    rows = [{"key": 1, "right": around, "left": around, "doc_id": 5, "place": k} for k in range(30, 1030)]
    found = [r for b in suffixes.compared(suffixes.pa.Table.from_pylist(rows, kinds).to_batches()) for r in b.to_pylist() if r["kept"] is None and r["start"] is not None]
    assert len(found) == suffixes.AROUND + 1
    assert {(r["start"], r["words"]) for r in found} == {(30 - o, 999 + suffixes.LEAST) for o in range(suffixes.AROUND + 1)}


@pytest.mark.parametrize("share", [0.1, 0.2])
def test_recall_at_exactly_a_share_of_edits(share):
    rng = random.Random(5)
    vocabulary = [f"x{k}" for k in range(3000)]
    items = [[*rng.sample(vocabulary, rng.randrange(15, 80))] for _ in range(150)]
    index = decontaminate.Items([(k, " ".join(w).encode()) for k, w in enumerate(items)])
    texts = []
    for w in items:
        n, edited = decontaminate.edits(len(w), 1 - share), list(w)
        for p in sorted(rng.sample(range(1, len(w) - 1), n), reverse=True):
            edited[p : p + 1] = rng.choice([[f"y{p}"], [f"y{p}", edited[p]] if n % 2 else []])
        text = [*(f"z{rng.randrange(3000)}" for _ in range(30)), *edited, *(f"z{rng.randrange(3000)}" for _ in range(30))]
        assert least_edits(w, text) == n
        texts.append(" ".join(text).encode())
    found = {(t, i) for t, i, *_ in index.matches(texts)}
    hits = sum((k, k) in found for k in range(len(items)))
    assert hits >= {0.1: 0.97, 0.2: 0.9}[share] * len(items)


def test_only_the_outer_classes_of_a_task_are_open():
    kinds = suffixes.pa.schema([("key", suffixes.pa.int64()), ("right", suffixes.pa.binary()), ("left", suffixes.pa.binary()), ("doc_id", suffixes.pa.int64()), ("place", suffixes.pa.int32())])
    around = b"\1" * 4 * suffixes.AROUND
    rows = [{"key": k // 4, "right": around, "left": around, "doc_id": k % 4, "place": 30} for k in range(40)]
    found = [r for b in suffixes.compared(iter(suffixes.pa.Table.from_pylist(rows, kinds).to_batches(max_chunksize=3))) for r in b.to_pylist()]
    assert {r["key"] for r in found if r["place"] is not None} == {0, 9}
    assert sorted(r["doc_id"] for r in found if r["kept"] is False) == sorted([1, 2, 3] * 10)
    # Each of the two open classes sends its smallest document's windows alone.
    assert {r["doc_id"] for r in found if r["kept"] is None and r["start"] is not None} == {0}


def test_leaks_of_items_in_blocks_by_number_and_of_a_long_item(spark):
    rng = random.Random(12)
    words = lambda n: [f"x{rng.randrange(5000)}" for _ in range(n)]
    items = [words(20) for _ in range(30)] + [words(400)]
    edited = list(items[-1])
    for p in rng.sample(range(400), 40):
        edited[p] = "other"
    rows = [(k, " ".join([*words(30), *w, *words(30)])) for k, w in enumerate([*items[:-1], edited])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    whole = {tuple(r) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {r[:2] for r in whole} == {(k, k) for k in range(31)}
    assert {tuple(r) for r in decontaminate.leaks(docs, benchmark, block_items=7).collect()} == whole


@pytest.mark.parametrize(("widths", "most"), [([], 5), ([1, 1, 1, 1], 2), ([1, 2, 3, 50, 60], 10), ([100], 10)])
def test_runs_of_rows_hold_a_bounded_number(widths, most):
    cut = list(decontaminate.runs_of(decontaminate.np.array(widths, int), most))
    assert [k for a, b in cut for k in range(a, b)] == list(range(len(widths)))
    assert all(b - a == 1 or (b - a) * widths[b - 1] <= most for a, b in cut)
