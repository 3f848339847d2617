"""Language ID, fingerprints, archives and the pipeline."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from relevo.llm import fingerprints, frames, langid, packing, queries, warc

from ..conftest import SF_MID, SF_SMALL
from .conftest import messy_rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()), PIECES, train_rows=60, rounds=2)
    found = docs.where(langid.held_out()).join(langid.predict(docs, model), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
    assert found.where("score < 0 or score > 1").count() == 0


def test_marginal_probability_sums_over_all_segmentations():
    lat = langid.lattice(PIECES)
    p = np.random.default_rng(0).random((len(lat.pieces) + 1, 2)) / 50
    word = langid.START + "bade"
    known = {w: i for i, w in enumerate(lat.pieces)}

    def total(rest):
        if not rest:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, len(rest) + 1):
            if rest[:n] in known:
                out = out + p[known[rest[:n]]] * total(rest[n:])
        return out

    assert np.allclose(langid.forward(lat.arcs(word), len(word), p)[-1], total(word))
    scorer = langid.Scorer(langid.Model(PIECES, ["x", "y"], np.zeros(2), p))
    assert np.allclose(scorer._sums([[word, word, "de"]])[0], 2 * np.log(total(word)) + np.log(total("de")))


def test_expected_uses_sum_over_all_segmentations():
    lat = langid.lattice(PIECES)
    p = np.random.default_rng(1).random((len(lat.pieces) + 1, 2)) / 50
    known = {w: i for i, w in enumerate(lat.pieces)}
    found, column, n = [langid.START + "bade", "den", langid.START + "日b", "x"], np.array([0, 1, 1, 0]), np.array([3, 1, 2, 5])

    def ways(rest):
        if not rest:
            yield []
        for k in range(1, len(rest) + 1):
            piece = known.get(rest[:k], lat.other if k == 1 else None)
            if piece is not None:
                yield from ([piece, *more] for more in ways(rest[k:]))

    want = np.zeros(p.shape)
    for word, c, times in zip(found, column, n, strict=True):
        weighed = [(way, np.prod(p[way, c])) for way in ways(word)]
        for way, x in weighed:
            for piece in way:
                want[piece, c] += times * x / sum(y for _, y in weighed)
    assert np.allclose(langid.expected_uses(lat, found, column, n, p), want)


#: Texts in no language of the tables.
FOREIGN = {
    1: "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto " * 3,
    2: "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem " * 3,
    3: "qxzv wkjp zzqk vvxq pqzj xkcd qwzx jjqv zxkw vqpz kxzj wqvx " * 6,
    4: "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。" * 5,
    5: "alle mensen worden vrij en gelijk in waardigheid en rechten geboren zij zijn begiftigd met verstand en geweten " * 3,
}


def test_stage_drops_languages_it_has_not_learned(spark):
    """A posterior compares the learned languages only; unknown ones have one too. Learned rows all stay."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out()), PIECES)
    foreign = spark.createDataFrame(list(FOREIGN.items()), "doc_id long, text string")
    assert min(r["score"] for r in langid.predict(foreign, model).collect()) > 0.5
    assert langid.keep_known(foreign, model).count() == 0
    held = docs.where(langid.held_out())
    posterior = langid.predict(held, model).where("lang_pred != 'und' and score >= 0.5").count()
    assert langid.keep_known(held, model).count() == posterior


def test_fit_is_not_cut_short(spark):
    """The production fit: 1,000 rows a language, three rounds; each language held out."""
    assert (langid.TRAIN_ROWS, langid.ROUNDS) == (1000, 3)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    found = docs.where(langid.held_out()).join(langid.predict(docs, langid.fit(docs.where(~langid.held_out()), PIECES)), "doc_id")
    for r in found.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right")).collect():
        assert r["right"] > 0.95, r


def test_no_letters_and_no_training_rows(messy, none):
    model = langid.fit(messy.where("doc_id < 20"), PIECES, rounds=1)
    got = {(r["doc_id"]): r for r in langid.predict(messy, model).collect()}
    assert got[18]["lang_pred"] == got[21]["lang_pred"] == got[24]["lang_pred"] == "und" and got[18]["score"] == 0.0
    assert got[0]["lang_pred"] in ("en", "de")
    assert langid.predict(messy, model).count() == messy.count() and langid.predict(none, model).count() == 0
    empty = langid.fit(none, PIECES)
    assert {r["lang_pred"] for r in langid.predict(messy, empty).collect()} == {"und"}


def test_fingerprints_estimate_generalised_jaccard():
    s = fingerprints.Sampler(samples=512, term_bits=14)
    words = [f"w{i}" for i in range(120)]
    a, b = " ".join(words[:80] * 2), " ".join(words[20:100])
    (x, u), (y, v) = s.terms(a), s.terms(b)
    x, y = dict(zip(x, u, strict=True)), dict(zip(y, v, strict=True))
    true = sum(min(x.get(t, 0), y.get(t, 0)) for t in x | y) / sum(max(x.get(t, 0), y.get(t, 0)) for t in x | y)
    assert abs(fingerprints.likeness(s.fingerprint(a), s.fingerprint(b)) - true) < 0.08
    assert s.fingerprint(a) == s.fingerprint(a + " ") and s.fingerprint("") == s.fingerprint(" \n") == "0" * 2048


def test_long_texts_estimate_jaccard_of_their_words():
    """At 20,000 words and more, against the pairs of words themselves."""
    rng = np.random.default_rng(3)
    s = fingerprints.sampler()

    def prose(n, words):
        return [f"w{i}" for i in rng.integers(0, words, n)]

    def pairs(words):
        return Counter(zip(words, words[1:], strict=False))

    common = prose(60_000, 100_000)
    cases = [(prose(100_000, 100_000), prose(100_000, 100_000)), (prose(20_000, 100_000), prose(20_000, 100_000)),
             (common + prose(40_000, 100_000), common + prose(40_000, 100_000)), (prose(30_000, 100), prose(30_000, 100))]
    for a, b in cases:
        x, y = pairs(a), pairs(b)
        true = sum((x & y).values()) / sum((x | y).values())
        found = fingerprints.likeness(s.fingerprint(" ".join(a)), s.fingerprint(" ".join(b)))
        assert abs(found - true) < 0.02 + 3 * (true * (1 - true) / s.samples) ** 0.5, (found, true)


def test_numbers_of_terms_are_gamma_and_uniform():
    s = fingerprints.Sampler(samples=4)
    ln_c, r, b = s.numbers[s._known(fingerprints.mix(np.arange(1, 10_001, dtype=np.uint64)))].transpose(1, 0, 2)
    for x, mean, var in ((np.exp(ln_c), 2, 2), (r, 2, 2), (b, 1 / 2, 1 / 12)):
        assert abs(x.mean() - mean) < 0.05 and abs(x.var() - var) < 0.1
    assert np.abs(np.corrcoef([np.exp(ln_c).ravel(), r.ravel(), b.ravel()]) - np.eye(3)).max() < 0.03


def test_edited_fingerprints(messy, none):
    got = fingerprints.edited_fingerprints(messy).collect()
    rows = sorted([(-(1 << 62) if k is None else k, t or "") for k, t, *_ in messy_rows()])
    s = fingerprints.sampler()
    want = []
    for i, (k, t) in enumerate(rows):
        n, after = len(t), rows[(i + 1) % len(rows)][1]
        edited = t[: n - n // 4] + after[: n // 4]
        want.append((None if k < 0 else k, n, edited, s.fingerprint(t), s.fingerprint(edited),
                     fingerprints.likeness(s.fingerprint(t), s.fingerprint(edited)), fingerprints.likeness(s.fingerprint(t), s.fingerprint(after))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert fingerprints.edited_fingerprints(none).count() == 0
    assert fingerprints.edited_fingerprints(messy.where("doc_id = 0")).first()["near_next"] == 1.0


def test_archives_round_trip(spark, monkeypatch):
    pages = [(1, "http://A.example.org/x?q=1", "<p>é</p>"), (2, "https://b.org", "<p>é</p>"), (3, None, None), (4, "c.net/\r\nz", ""),
             (5, "http://a.example.org/y", "a\r\n\r\nb"), (5, "http://a.example.org/y", "a\r\n\r\nb"), (None, "http://d.org/", "solo"), (6, "u", "x" * 70_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    for least in (0, 4):
        index = warc.write_archives(df, min_bytes=least)
        got = warc.read_records(warc.entries(index)).collect()
        assert len(got) == len(pages)
        first: dict = {}
        for k, _, h in pages:
            if k is not None and len((h or "").encode()) >= least:
                first[h or ""] = max(first.get(h or "", k), k)
        want = []
        for k, _, h in pages:
            raw = (h or "").encode()
            to = first.get(h or "")
            again = k is not None and to is not None and to != k
            want.append((k, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", to if again else None))
        assert sorted([(r["page"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == sorted(want, key=str)
        assert {r["payload"] for r in got if r["record_type"] == "response"} == {h or "" for _, _, h in pages}
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 2)
    index = warc.write_archives(df, min_bytes=least)
    every = sorted(map(str, warc.entries(index).collect()))
    assert sorted(map(str, warc.captures_of(index, df.unionByName(df)).collect())) == every
    some = spark.createDataFrame([("http://a.example.org/y",), ("http://missing.org",), (None,), ("~",)], "url string")
    keys = {warc.url_key(u) for u in ("http://a.example.org/y", None)}
    want = sorted(str(r) for r in warc.entries(index).collect() if r["key"] in keys)
    assert sorted(map(str, warc.captures_of(index, some).collect())) == want and 0 < len(want) < len(every)
    assert warc.captures_of(index, some.limit(0)).count() == 0 == warc.captures_of(index.limit(0), some).count()
    found = warc.lookup(index, ["http://a.example.org/y", "https://b.org", "http://missing.org"]).collect()
    assert sorted(r["page"] for r in found) == [2, 5, 5]
    assert warc.url_key("http://User@B.Example.org:80/p?q") == "org,example,b:80)/p?q"
    assert warc.read_records(warc.entries(warc.write_archives(df.limit(0)))).count() == 0


def test_damaged_record_is_an_error():
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\r\n\r\n")


def test_pipeline_stages_on_messy_rows(spark, messy, none):
    for df in (messy, none):
        docs = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = frames.written(stage(spark, docs, SF_SMALL), name)
            assert docs.schema.names == df.schema.names, name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, messy, SF_SMALL).collect()}
    assert not kept & {18, 21, 24} and {0, 3, 6, 27} <= kept
    single = [r["doc_id"] for r in corpus_pipeline.ngram_jaccard(spark, messy, SF_SMALL).collect()]
    assert sorted(single, key=str) == sorted({k for k, *_ in messy_rows() if k not in (3, 6, 30)} - {None}, key=str) + [None, None]


def test_pipeline_keeps_clean_rows_that_share_an_id(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    a, b, c, d = map(text, "abcd")
    near = b + " more"
    rows = [(7, a, "y"), (7, b, "x"), (7, a, "x"), (9, near, "x"), (9, c, "x"), (3, near, "x"), (3, d, "x"), (7, None, "x"), (7, "", "x"), (None, a, "x")]
    rows += [(5, text(f"e{i}x"), "x") for i in range(10)]
    want = [r for r in rows if r not in ((7, a, "y"), (7, b, "x"), (9, near, "x"))]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got = [tuple(r) for r in corpus_pipeline.ngram_jaccard(spark, df, SF_SMALL).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_runs_on_the_documents(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    total = rows.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert total[1] <= -(-total[0] // 2048) * 1.1
    assert packing.SHARD_PIECES > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted(con.sql(f"SELECT {', '.join(cols)} FROM want").fetchall(), key=str)


def test_every_operator_is_registered():
    assert {int(n.split("_")[0][2:]) for n in queries.QUERIES} == set(range(1, 14))
