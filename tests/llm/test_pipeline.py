"""The pipeline's stages, each against a plain version on its own input, and WARC archives and their index."""

import gzip
import os
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from test_near_duplicates import plain_containment, plain_fingerprint, roots
from test_spans import plain_secrets

import corpus_pipeline
from shopgrain.llm import queries, sentencepiece_codec, warc
from shopgrain.llm.common import table
from shopgrain.operators.checkpoints import materialise, new_path


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = as_rows(docs)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "decontaminate", "secrets", "encode"]
    items = list(zip(*pq.read_table(os.path.join(sf_dir, "benchmark.parquet"), columns=["item_id", "text"]).to_pydict().values(), strict=True))
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, sf_dir), name)
        after = as_rows(out)
        if name != "encode":
            assert out.columns == docs.columns
        if name == "language":
            assert set(after) <= set(before) and len(after) >= 0.99 * len([r for r in before if any(map(str.isalpha, r[1] or ""))])
        elif name == "near_dedup":
            fps = {r[0]: plain_fingerprint(r[1]) for r in before}
            ids = sorted(fps)
            links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4]
            assert Counter(after) == Counter(r for r in before if roots(ids, links)[r[0]] == r[0])
        elif name == "decontaminate":
            bad = {d for d, *_ in plain_containment([r[:2] for r in before], items)}
            assert Counter(after) == Counter(r for r in before if r[0] not in bad)
        elif name == "secrets":
            texts = {r[0]: r for r in after}
            assert set(texts) == {r[0] for r in before}
            for r in before:
                new = texts[r[0]]
                assert (new == r) if not plain_secrets(r[1] or "") and "[secret]" not in new[1] else not plain_secrets(new[1])
                assert new[-1] == len(new[1])
        else:
            library = sentencepiece_codec.word_table(public_tokenizers.path(queries.MODEL)).model
            texts = {r[0]: r[1] or "" for r in before}
            assert len(after) == len(before)
            for r in out.collect():
                ids = library.encode(texts[r["doc_id"]], add_eos=True)
                assert r["ids"] == ids and r["n_tokens"] == len(ids)
                assert r["lossless"] == (library.decode(ids) == texts[r["doc_id"]])
        docs, before = out, after


def test_stages_keep_other_columns_and_take_odd_rows(spark, sf_dir, rows):
    data = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "the cat and the dog " * 9, None, None, None),
            (4, "and the dog token=abcdefghij1 " * 9, "en", "s", None), (5, "and the cat " * 40_000, "en", "s", 480_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows(schema, data), rows(schema, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, given, sf_dir), name)
            n = out.count()
            assert n <= given.count() and (n == given.count() or name in ("language", "near_dedup"))
            if name != "encode":
                assert out.schema.simpleString() == given.schema.simpleString()


PAGES = "page_id long, url string, html string"
BODY = "<p>é" + "x" * 1200


def pages():
    rows = [(i, f"http://www.site{i % 7}.example.com:80/a/{i % 40}?q={i}#f", f"<p>{i}" + "y" * (i * 9 % 1500)) for i in range(300)]
    rows += [(1000 + i, f"https://hot.example.org/{i % 2}", BODY) for i in range(60)]
    rows += [(2000 + i, "http://hot.example.org/0", "short") for i in range(4)]
    return rows + [(3000, None, None), (3001, "", ""), (3002, "not a url\n\ttab", BODY), (3003, "http://ü.example/ß", "é" * 600),
                   (None, "http://null.example/", BODY), (1059, "https://hot.example.org/1", BODY)]


def archived(spark, df, block_lines=7):
    folder = new_path(spark, "warc")
    captures = warc.write_archives(df, folder + "/archives")
    return warc.build_index(captures, folder + "/index", folder + "/archives", block_lines)


def test_archives_round_trip_through_the_index(spark, rows):
    data = pages()
    index = archived(spark, rows(PAGES, data))
    found = warc.read_records(index, warc.lookup(index, spark.createDataFrame(data, PAGES)), payload=True).collect()
    assert len(found) == len(data)
    for r in found:
        key = None if r["id"] is None else int(r["id"])
        html = next(h or "" for i, _, h in data if i == key)
        copies = [i for i, _, h in data if (h or "") == html and i is not None]
        again = len(html.encode()) >= 1000 and len(copies) > 1 and key != max(copies)
        assert r["payload_bytes"] == len(html.encode())
        assert (r["record_type"], r["refers_to"]) == (("revisit", str(max(copies))) if again else ("response", None))
        assert r["payload"] == (None if again else html)


def test_lookup_reads_one_url(spark, rows):
    data = pages()
    index = archived(spark, rows(PAGES, data))
    ask = lambda *urls: warc.lookup(index, spark.createDataFrame([(u,) for u in urls], "url string"))
    assert sorted(int(r["id"]) for r in ask("HTTP://Hot.Example.org/0", "https://www.hot.example.org:443/0#x").collect()) == sorted(
        i for i, u, _ in data if u and u.endswith("hot.example.org/0"))
    assert ask("http://absent.example/").count() == 0 and ask("http://zzz.zz/").count() == 0
    assert [r["id"] for r in ask("http://site3.example.com/a/3?q=3").collect()] == ["3"]


def test_empty_archives(spark, rows):
    index = archived(spark, rows(PAGES, []))
    assert warc.lookup(index, spark.createDataFrame([("http://a.b/",)], "url string")).count() == 0


def test_archives_are_standard_gzip_members(spark, rows, tmp_path):
    index = archived(spark, rows(PAGES, pages()[:20]))
    folder = index.archives.removeprefix("file:")
    raw = b"".join(gzip.open(os.path.join(folder, f)).read() for f in os.listdir(folder))
    assert raw.count(b"WARC/1.1\r\n") == 20 and raw.endswith(b"\r\n\r\n")


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com:80/A?b#c", "com,example)/A?b"), ("https://u:p@a.b.org:8080", "org,b,a:8080)/"),
    ("example.com?x=1", "com,example)/?x=1"), (None, ""), ("", ""),
])
def test_url_keys(url, key):
    assert warc.surt(url) == key
