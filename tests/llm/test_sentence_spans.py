from __future__ import annotations

import random

import xxhash

from tallyspark.llm import sentence_spans as ss


def tag(text):
    """The order of texts that share an id: Spark's hash of the text."""
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def slow(rows, least=ss.RUN_SENTENCES, words=ss.RUN_WORDS):
    """Brute force on strings: every run by its text, first occurrence by (id, text, place)."""
    def key(i, t):
        return (i is None, i or 0, tag(t), t or "")

    units = {key(i, t): ss.sentences(t or "") for i, t in rows}
    occur = {}
    for doc in sorted(units):
        own = [(n, u) for n, u in enumerate(units[doc]) if u[3]]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if b - a >= least and sum(u[3] for _, u in own[a:b]) >= words:
                    occur.setdefault(" ".join(u[2] for _, u in own[a:b]), []).append(
                        (doc, own[a][0], own[b - 1][0]))
                    break
    gone = {}
    for places in occur.values():
        for doc, i, j in places[1:]:
            gone.setdefault(doc, set()).update(range(i, j + 1))
    out = []
    for i, t in rows:
        u, g = units[key(i, t)], gone.get(key(i, t), set())
        out.append((i, t if not g else "".join((t or "")[s:e] for k, (s, e, _, _) in enumerate(u)
                                               if k not in g), len(g)))
    return sorted(out, key=str)


def test_documents_and_edge_rows(docs, edge_docs, no_docs):
    for d in (docs, edge_docs):
        rows = [(r.doc_id, r.text) for r in d.collect()]
        got = sorted(map(tuple, ss.dedup_documents(d).collect()), key=str)
        assert got == slow(rows)
    assert ss.dedup_documents(no_docs).collect() == []


def test_rows_that_share_an_id_are_cut_each_by_its_own_spans(spark):
    """Nothing in the unique text repeats; the other text of its id is a copy."""
    rng = random.Random(8)
    copy = " ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(120))
    own = " ".join(f"u{i}" for i in range(120))
    rows = [(0, copy), (1, copy), (1, own), (None, copy), (None, own + " more"), (1, own), (2, None)]
    got = sorted(map(tuple, ss.dedup_documents(spark.createDataFrame(
        rows, "doc_id long, text string")).collect()), key=str)
    assert got == slow(rows)
    texts = [(i, t) for i, t, _ in got]
    assert texts.count((1, own)) == 2 and (0, copy) in texts
    assert all(len(t.split()) < 40 for i, t, n in got if n and t and "p" in t[:1])


def test_one_word_apart_is_another_run():
    """Run hashes tell words and their order apart."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(50)}" for _ in range(4000)]
    seen = {}
    for start in range(0, 3900, 3):
        part = words[start:start + 60]
        _, hashes, first, last = ss.runs(" ".join(part))
        units = ss.sentences(" ".join(part))
        for h, i, j in zip(hashes.tolist(), first.tolist(), last.tolist(), strict=True):
            assert seen.setdefault(h, key := " ".join(u[2] for u in units[i:j + 1])) == key
    assert len(set(seen.values())) == len(seen)


def test_passage_in_many_documents(spark):
    passage = " ".join(f"Shared sentence number {i} goes on here." for i in range(12))
    rows = [(i, f"Opening {i * 31} of text {i}. {passage} Own closing words {i * 17} of {i}.")
            for i in range(120)]
    rows += [(500, "A clean text. It shares nothing. Not one sentence. At all, as it were.")]
    out = {r.doc_id: r for r in ss.dedup_documents(spark.createDataFrame(
        rows, "doc_id long, text string")).collect()}
    assert out[0].text == rows[0][1] and out[500].text == rows[-1][1]
    for i in range(1, 120):
        assert "Shared sentence" not in out[i].text
        assert out[i].text.startswith(f"Opening {i * 31}") and f"closing words {i * 17}" in out[i].text


def test_unpunctuated_passage_at_any_offset(spark):
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(120))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(11 + 3 * i)) + " " + passage +
             " " + " ".join(f"end{i}x{j}" for j in range(40))) for i in range(4)]
    out = {r.doc_id: r for r in ss.dedup_documents(spark.createDataFrame(
        rows, "doc_id long, text string")).collect()}
    for i in range(1, 4):
        left = sum(w in out[i].text.split() for w in set(passage.split()))
        assert left <= 40 and out[i].n_removed > 0
        assert all(f"own{i}x{j}" in out[i].text for j in range(8))


def test_sentences_cover_the_text(docs, edge_docs):
    for d in (docs, edge_docs):
        for r in d.collect():
            t = r.text or ""
            u = ss.sentences(t)
            assert "".join(t[s:e] for s, e, _, _ in u) == t


def test_columns_stay(edge_docs):
    out = ss.remove_repeated_spans(edge_docs)
    assert out.columns == [*edge_docs.columns, "n_removed"]
    clash = ss.remove_repeated_spans(edge_docs.withColumnRenamed("score", "n_removed"))
    assert clash.columns[-1] == "n_removed_"


def test_every_passage_of_51_words_holds_a_run():
    """Passages cut at random, with and without punctuation, put mid-sentence into two texts."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(3000)]

    def prose(n, stop):
        return [w + ("." if rng.random() < stop else "") for w in rng.choices(pool, k=n)]

    for stop in (0.0, 0.02, 0.04, 0.1, 0.3):
        for _ in range(300):
            passage = " ".join(prose(51, stop))
            found = []
            for _ in range(2):
                text = " ".join([*prose(rng.randint(0, 60), stop), passage,
                                 *prose(rng.randint(0, 60), stop)])
                found.append(set(ss.runs(text)[1].tolist()))
            assert found[0] & found[1]
