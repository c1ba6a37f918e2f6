"""The pipeline's run against each stage done by brute force."""

import re

import corpus_pipeline
from quayledger.llm import decontaminate, labelled, quality
from quayledger.llm.decontaminate import edits
from tests.llm.conftest import SF
from tests.llm.test_groups import brute
from tests.llm.test_texts import brute_repeats, least_edits


def test_run(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    net = quality.fit(labelled.sample(docs, labels, "quality", 5, 0, quality.SAMPLE_ROWS, quality.SAMPLE_CHARS))
    left = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    left = {d: t for d, t in left.items() if quality.scores(net, [t.encode()])[0] >= 0.3}
    stays = {d for d, _, c in brute(list(left.items())) if d == c}
    left = {d: t for d, t in left.items() if d in stays}
    _, later = brute_repeats(list(left.items()))
    cut = {}
    for d, t in left.items():
        spans = [m.span() for m in re.finditer(r"[^\x09-\x0D\x20]+", t)]
        for k in sorted(later[d], reverse=True):
            t = t[: spans[k][0]] + (t[spans[k + 1][0] :] if k + 1 < len(spans) else "") if k + 1 in later[d] or k + 1 >= len(spans) else t[: spans[k][0]] + t[spans[k + 1][0] :]
            spans[k + 1 :] = [(a - (spans[k + 1][0] - spans[k][0]), b - (spans[k + 1][0] - spans[k][0])) for a, b in spans[k + 1 :]] if k + 1 < len(spans) else []
            del spans[k]
        if t.split() or not later[d]:
            cut[d] = t
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, t in cut.items() if not any(len(set(i) & set(words(t))) >= 0.5 * len(set(i)) and least_edits(i, words(t)) <= edits(len(i), decontaminate.SIMILARITY) for i in items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == clean
    from quayledger.llm.tokens import words_of

    whole = words_of(None).whole
    texts: dict = {}
    for r in sorted(got, key=lambda r: r["start"]):
        texts[r["doc_id"]] = texts.get(r["doc_id"], b"") + bytes(r["ids"])
    for d in clean:
        assert whole.decode([int.from_bytes(texts[d][k : k + 4], "little") for k in range(0, len(texts[d]) - 4, 4)], skip_special_tokens=False) == cut[d]


def test_stages_on_odd_rows(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, none, SF).collect() == []
