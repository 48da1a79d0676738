"""Each stage against brute force on its own input."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from featherloom.llm.suffix_array import dedup_digest
from test_decontaminate import truth as contaminated
from test_repeats import words_truth

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classes(rows, shingle=5, percent=80):
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))}
                    if w else set())
    holders, root = {}, list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in holders[g]:
                common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i]:
            best[find(i)] = min(best.get(find(i), doc), doc)
    return sorted([*best.values(), *(d for (d, _), s in zip(rows, sets, strict=True) if not s)])


def test_stages(spark, folder):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup",
                                               "decontamination", "mixing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    text = lambda table: [(r[0], r[1]) for r in table.values()]
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialise(stage(spark, docs, folder))
        out = {r.doc_id: tuple(r)[:5] for r in docs.collect()}
        assert docs.columns[:5] == COLUMNS and len(out) == docs.count()
        if name == "toxicity":
            assert 0 < len(out) < len(rows)
        elif name == "near_duplicates":
            assert sorted(out) == classes(text(rows))
        elif name == "substring_dedup":
            for doc, n, gone, digest in words_truth(text(rows)):
                assert (doc in out) == (gone == 0 or gone < n)
                if doc in out:
                    assert out[doc][4] == len(out[doc][1])
                    if not gone:
                        assert out[doc][1] == rows[doc][1]
        elif name == "decontamination":
            assert sorted(out) == sorted(r[0] for r in contaminated(text(rows), bench)
                                         if not r[-1])
        if name != "substring_dedup":
            assert all(out[d] == rows[d] for d in out)
        rows = out
    assert entry.queries()["pipeline"] is pipeline.run
    assert docs.where("taken > 3 * size or taken <= 0").isEmpty()


def test_nulls_and_repeats(spark, folder):
    row = [(1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13),
           (2, None, None, None, None), (2, None, None, None, None), (3, "", "en", "t", 0),
           (None, "one two three four five six", "en", "t", 27), (4, "A B c d e f g", "", "s", 13)]
    docs = spark.createDataFrame(row, "doc_id long, text string, lang string, source string, "
                                      "n_chars long")
    kept = sorted((r.doc_id or 0, r.text or "") for r in pipeline.drop_near_duplicates(
        spark, docs, folder).collect())
    assert kept == [(0, "one two three four five six"), (1, "a b c d e f g"), (2, ""), (2, ""),
                    (3, "")]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).columns[:5] == COLUMNS
        assert stage(spark, docs, folder).count() <= 7
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_unlike_texts_with_null_or_equal_ids_stay(spark, folder):
    texts = [(None, "one two three four five six"), (None, "red green blue pink grey black"),
             (None, "ONE two three four five six"), (5, "north south east west up down"),
             (5, "iron gold tin lead zinc copper"), (5, "iron gold tin lead zinc copper")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in texts],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
    kept = pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in kept) == [
        (0, texts[0][1]), (0, texts[1][1]), (5, texts[4][1]), (5, texts[3][1])]


def test_columns_with_names_of_added_ones_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    names = ["score", "n_words", "n_removed", "kept", "size", "taken", "copies", "spans", "target",
             "source_size", "text_tag", "doc_order", "starts", "ends", "Class_Root"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, docs.doc_id * 0 + i)
    columns = docs.columns
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[:len(columns)] == columns
        rows = out.collect()
        assert rows and all(tuple(r)[5:len(columns)] == tuple(range(len(names))) for r in rows)
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert out.columns[len(columns):] == ["_size", "_source_size", "_target", "_taken", "_copies",
                                          "_spans"]


def test_null_ids_whose_short_hashes_collide(spark, folder):
    """Texts without an id whose hashes agree in the low 32 bits are told apart."""
    import xxhash
    seen, pair = {}, None
    for i in range(400000):
        text = f"t{i} " + " ".join(f"u{i}w{j}" for j in range(30))
        low = xxhash.xxh64_intdigest(text, seed=42) & 0xFFFFFFFF
        if low in seen:
            pair = seen[low], text
            break
        seen[low] = text
    assert pair
    first, second = pair
    rows = [(1, first), (None, first), (None, second), (None, "short")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
    cut = sorted((r.doc_id or 0, r.text) for r in pipeline.cut_passages(spark, docs, folder)
                 .collect())
    assert cut == [(0, "short"), (0, second), (1, first)]
    bytes_left = {r.n_removed for r in dedup_digest(docs).where("doc_id is null").collect()}
    assert bytes_left == {0, len(first)}
    kept = pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "short"), (0, second), (1, first)]
