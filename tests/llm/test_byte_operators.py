"""WARC, top-k search, BPE, chat formatting, sharding, token files and packing
against brute force, the tokenizers library and exact round trips."""

import hashlib
import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import bpe, chat_format, mixcoder, packing, sharding, token_files, tokens, topk_search, warc
from zonecast.llm.queries import vocabulary
from zonecast.llm.util import scratch_folder

WORD_BPE, BYTE_BPE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
ODD = ["", " ", "  x", "x  ", "a  b\n\nc", "é É İ ΣΑΣ", "x<|endoftext|> y<|startoftext|>z", "ﬁ ẞ ​ \x1c a\x85b\xa0c", "😀 漢字",
       "'s'S don't", "a" * 3000, "é ́x", "\x00 \x7f", "tab\tsep\x0bx"]


def odd_texts(seed, n):
    r = random.Random(seed)
    return ODD + ["".join(r.choice("abcdeé ÄÖß'.!,#\n\t  0123\x1c\x85\xa0́ΣσİıK漢<|>") for _ in range(r.randint(0, 60))) for _ in range(n)]


# -------------------------------------------------------------------- WARC
PAGES = "page_id bigint, url string, html string, digest int, shard string"


def page_rows():
    rows = [(i, f"http://x/{i}", f"<p>{i % 7} é</p>" if i % 3 else f"only {i}") for i in range(60)]
    rows += [(70, None, None), (71, "http://e", ""), (72, "a b\r\nc", "long " * 5000), (None, "n", "<p>1 é</p>"), (None, "n", "none"), rows[5], rows[5]]
    return [(*r, 1, "s") for r in rows]


def test_warc_round_trip(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGES).repartition(6)
    folders = [scratch_folder(spark, "t-warc") for _ in range(2)]
    warc.write_warc(df, folders[0], file_bytes=600, shard_bytes=2000)
    warc.write_warc(df.repartition(3), folders[1], file_bytes=600, shard_bytes=2000)
    got = warc.read_warc(spark, folders[0]).collect()
    digest = {t: warc.base32_sha1((t or "").encode()) for _, _, t, *_ in rows}
    top = {}
    for i, _, t, *_ in rows:
        top[digest[t]] = max(top.get(digest[t], -1), -1 if i is None else i)
    assert len(got) == len(rows)
    assert sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest) for r in got) == \
        sorted((i if i is not None else -1, len((t or "").encode()), digest[t]) for i, _, t, *_ in rows)
    for r in got:
        response = r.record_type == "response"
        assert r.refers_to == (None if response else top[r.payload_digest])
        assert not response or (r.page_id if r.page_id is not None else -1) == top[r.payload_digest]
    assert all(sum(1 for r in got if r.payload_digest == d and r.record_type == "response") == 1 for d in top)
    # the same table in another layout gives the same bytes; small limits give many files
    files = []
    for f in folders:
        _, path = warc.file_system(f)
        files.append({n: hashlib.sha256(open(f"{path}/{n}", "rb").read()).hexdigest() for n in os.listdir(path) if n.endswith(".gz")})
    assert files[0] == files[1] and len(files[0]) > 3
    assert {r.file: r.sha256 for r in spark.read.schema(warc.MANIFEST).json(folders[0] + "/manifest").collect()} == files[0]


def test_warc_limits_and_damage(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    folder = scratch_folder(spark, "t-warc")
    warc.write_warc(df, folder, min_bytes=3)
    assert {r.page_id: r.record_type for r in warc.read_warc(spark, folder).collect()} == {
        1: "response", 2: "response", 3: "revisit", 4: "response"}
    _, path = warc.file_system(folder)
    name = next(n for n in os.listdir(path) if n.endswith(".gz"))
    data = bytearray(open(f"{path}/{name}", "rb").read())
    open(f"{path}/{name}", "wb").write(data[:-9])
    with pytest.raises(Exception, match="bytes|record|decompress"):
        warc.read_warc(spark, folder).collect()
    empty = scratch_folder(spark, "t-warc")
    warc.write_warc(df.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


# ------------------------------------------------------------------- top-k
def brute_topk(vectors, queries, k):
    out = {}
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in ok:
        if i in queries:
            s = sorted(((-sum(a * b for a, b in itertools.zip_longest(q, c, fillvalue=0)), j) for j, c in ok if j != i))
            out[i] = [(j, -n) for n, j in s[:k]]
    return out


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_GROUP", 5)
    monkeypatch.setattr(topk_search, "CANDIDATE_GROUP", 40)
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(r.normal(size=37), 1)]) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 37), (304, [float("inf")] * 37), (305, [1.0, -2.0]), (None, [1.0] * 37), rows[7], rows[7]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, rank int, score string").repartition(3)
    got = {}
    for x in topk_search.top_k(df, df.where("vec_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    want = brute_topk(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 5)
    assert got == want
    assert topk_search.top_k(df.limit(0), df).count() == 0


def test_topk_prunes_without_loss():
    r = np.random.default_rng(5)
    c = np.floor(r.normal(size=(5000, 64)) * np.linspace(40, 1, 64))
    q = c[:20]
    a, b, s = topk_search.search_cell(np.arange(20), q, np.arange(5000), c, 5)
    for i in range(20):
        score = c @ q[i]
        order = [j for j in np.lexsort((np.arange(5000), -score)) if j != i][:5]
        assert [(x, y) for w, x, y in zip(a, b, s, strict=True) if w == i] == [(j, int(score[j])) for j in order]
    big = np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 2.0], [3.0, 4.0]])
    _, b, s = topk_search.search_cell(np.array([0]), big[:1], np.arange(3), big, 2)
    assert (b, s) == ([1, 2], [2 ** 60 + 2, 3 * 2 ** 30 + 4])


# --------------------------------------------------------------------- BPE
def test_word_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(WORD_BPE), odd_texts(1, 400)
    ids = [np.frombuffer(x, "<i4") for x in bpe.load(WORD_BPE).encode(texts)]
    for t, got in zip(texts, ids, strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert got.tolist() == want, t
        assert bpe.load(WORD_BPE).decode(got) == library.decode(want, skip_special_tokens=False)
    df = spark.createDataFrame([(1, None, 5, "t"), (2, "don't", 6, "u")], "doc_id bigint, text string, IDS int, decoded string")
    out = bpe.encode(df, WORD_BPE, decoded="decoded")
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert [(r.doc_id, r.ids, r.decoded) for r in out.orderBy("doc_id").collect()] == [
        (1, [], ""), (2, library.encode("don't").ids, library.decode(library.encode("don't").ids, skip_special_tokens=False))]
    again = bpe.decode(out.drop("decoded"), WORD_BPE, text="x").orderBy("doc_id").collect()
    assert [r.x for r in again] == ["", library.decode(library.encode("don't").ids, skip_special_tokens=False)]
    assert bpe.encode(df.limit(0), WORD_BPE).count() == 0


def test_byte_bpe_equals_library():
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(BYTE_BPE), odd_texts(2, 1500)
    for t, got in zip(texts, tokens.load(BYTE_BPE).encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


# -------------------------------------------------------------------- chat
def test_chat_round_trip(spark):
    texts = ["", "\\", "\\\\###", "####", "</turn>", "</turn>\n### user: x", "a\\</turn>b", "é漢\n", "###", "#", "<", "</turn", "x" * 5000, None]
    roles = ["user", "assistant", "system", "we: ird\\", "### ", None, ""]
    rows = [(c, t, roles[(c * 3 + t) % len(roles)], texts[(c + t * 5) % len(texts)]) for c in range(20) for t in range(c % 9 + 1)]
    rows += [(None, None, "assistant", "lost"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted int").repartition(5)
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), (role is not None, role or ""), (text is not None, text or "")))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = b"".join(chat_format.TURN_MARK + chat_format.escape(r.encode(), b":") + b": " + chat_format.escape(t.encode()) + chat_format.TURN_END for r, t in turns)
        assert tuple(got[c]) == (c, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                                 hashlib.sha256(loss.encode()).hexdigest(), len(formatted.decode()))
        assert [(a.decode(), b.decode()) for a, b in chat_format.parse(formatted)] == turns
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


# ---------------------------------------------------------------- sharding
def test_shards(spark):
    r = random.Random(1)
    rows = [(i, "é" * r.randint(0, 60)) for i in range(400)] + [(7, "hot" * 10)] * 200 + [(8, "x" * 900), (8, "x" * 300), (None, "n" * 10), (9, None)]
    df = spark.createDataFrame([(a, b, "s", 1) for a, b in rows], "doc_id bigint, text string, shard string, cell int").repartition(4)
    limit = 800
    out = sharding.assign_shards(df, limit=limit)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "cell", "shard", "shard_depth", "shard_bytes", "shard_rows"]
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == sorted(rows, key=str)
    size, count, ids = {}, {}, {}
    for x in got:
        size[x.shard] = size.get(x.shard, 0) + len((x.text or "").encode())
        count[x.shard] = count.get(x.shard, 0) + 1
        ids.setdefault(x.shard, set()).add(x.doc_id)
    assert all((x.shard_bytes, x.shard_rows) == (size[x.shard], count[x.shard]) for x in got)
    assert all(b <= limit or count[s] == 1 for s, b in size.items())

    def bits(key):
        return int(hashlib.md5(str(key).encode() if key is not None else b"\0null").hexdigest()[:15], 16)

    for x in got:
        prefix = x.shard[:x.shard_depth]
        assert f"{bits(x.doc_id):060b}"[:x.shard_depth] == prefix
    total = {}  # only oversized buckets are split: every parent exceeds the limit
    for a, b in rows:
        for d in range(61):
            p = f"{bits(a):060b}"[:d]
            total[p] = total.get(p, 0) + len((b or "").encode())
    assert all(not s or total[s[:len(s.rstrip('0123456789!#')) or x.shard_depth][: x.shard_depth - 1]] > limit
               for x in got if (s := x.shard) and x.shard_depth < 60)
    assert sharding.assign_shards(df.limit(0)).count() == 0


def test_warc_shards_of_far_ids_get_a_task_each(spark, monkeypatch):
    rows = [(i, f"http://x/{i}", f"page {i} " * 30) for i in (-(1 << 63), (1 << 63) - 1, 0, *range(5, 40))]
    folder = scratch_folder(spark, "t-warc")
    tasks = []
    inner = warc._write

    def write(*a):
        run = inner(*a)

        def seen(batches):
            from pyspark import TaskContext
            for b in run(batches):
                yield b.set_column(0, b.schema.names[0], pa.array([f"{TaskContext.get().partitionId()}:{x}" for x in b.column(0).to_pylist()]))
        import pyarrow as pa
        return seen

    manifest = warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), folder, shard_bytes=600)
    assert sorted(r.page_id for r in warc.read_warc(spark, folder).collect()) == sorted(r[0] for r in rows)
    assert manifest.count() > 3
    monkeypatch.setattr(warc, "_write", write)
    names = [r[0] for r in warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string"), scratch_folder(spark, "t-warc"), shard_bytes=600).collect()]
    tasks = [n.split(":")[0] for n in names]
    assert len(set(tasks)) > 3  # files of different shards come from different tasks


# ------------------------------------------------------ chat: slices by bytes
def test_chat_slices_give_the_same_and_take_little_memory(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    r = random.Random(9)
    texts_ = [t for t in odd_texts(8, 80)] + ["### Assistant: </turn> \\", None, "x" * 300]
    rows = pa.RecordBatch.from_pydict({"conv_id": list(range(len(texts_))), "turn": [0] * len(texts_),
                                       "role": [r.choice(["user", "assistant", "a:b", None]) for _ in texts_], "text": texts_})

    def formatted(batch):
        out = [x for b in chat_format._format(iter([batch])) for x in b.to_pylist()]
        assert len(out) == batch.num_rows
        return out

    whole = formatted(rows)
    for limit in (1, 16, 100):
        monkeypatch.setattr(chat_format, "SLICE_BYTES", limit)
        assert formatted(rows) == whole
    monkeypatch.setattr(chat_format, "SLICE_BYTES", 1 << 19)
    big = pa.RecordBatch.from_pydict({"conv_id": [1] * 401, "turn": list(range(401)), "role": ["user"] * 401, "text": ["ab # \\" * 17_000] * 400 + ["y" * (4 << 20)]})
    tracemalloc.start()
    for b in chat_format._format(iter([big])):
        assert b.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # of 45 MB of text, at 25 bytes a byte for one slice


# ------------------------------------------------------------- token files
def test_coder_round_trips():
    r = np.random.default_rng(1)
    for n in (0, 1, 5, 63, 64, 65, 1000):
        for ids in (r.integers(0, 65536, n), np.zeros(n), np.full(n, 65535), r.zipf(1.3, n) % 50000):
            ids = ids.astype("<u4")
            assert (mixcoder.decode_run(mixcoder.encode_run(ids, 64), n, 64) == ids).all()
    ids = np.tile(r.integers(0, 50000, 50), 100).astype("<u4")
    blocks = mixcoder.encode_run(ids)
    assert sum(map(len, blocks)) < len(ids)  # under 8 bits an id where contexts repeat
    broken = bytearray(blocks[0])
    broken[20] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        mixcoder.decode_run([bytes(broken), *blocks[1:]], len(ids))
    with pytest.raises(ValueError, match="checksum"):
        mixcoder.decode_run([blocks[0], blocks[1][:20] + b"abcd" + blocks[1][24:], *blocks[2:]], len(ids))
    wide = np.concatenate([r.integers(0, 1 << 32, 300), [0, (1 << 32) - 1, 70000]]).astype("<u4")  # any width
    assert (mixcoder.decode_run(mixcoder.encode_run(wide, 64), len(wide), 64) == wide).all()


def test_coder_beats_an_order_0_code_and_zlib_on_real_text():
    import pyarrow.parquet as pq

    texts_ = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    ids = np.frombuffer(b"".join(tokens.load(BYTE_BPE).encode([t or "" for t in texts_])), "<u4")
    coded = mixcoder.encode_run(ids)
    assert (mixcoder.decode_run(coded, len(ids)) == ids).all()
    bits = 8 * sum(map(len, coded)) / len(ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert bits < -(share * np.log2(share)).sum()
    assert bits < 8 * len(zlib.compress(ids.astype("<u2").tobytes(), 6)) / len(ids)


def test_coder_takes_few_wide_steps(monkeypatch):
    r, steps = np.random.default_rng(2), [0]
    predict = mixcoder._Model.predict

    def counted(self):
        steps[0] += 1
        predict(self)

    monkeypatch.setattr(mixcoder._Model, "predict", counted)
    ids = (r.zipf(1.3, 40_000) % 50_000).astype("<u4")
    coded = mixcoder.encode_run(ids)
    assert steps[0] <= 4096  # 8,000 when blocks were twice as long
    assert (mixcoder.decode_run(coded, len(ids)) == ids).all()
    assert steps[0] <= 2 * 4096
    assert token_files.RUN_IDS // mixcoder.BLOCK >= 2048  # ids per step of a full run


def test_coder_where_ids_take_many_bits_or_none():
    r = np.random.default_rng(3)
    many = r.permutation(np.arange(70_000)).astype("<u4")  # the prior's places are searched for, words run out of their first room
    assert len(many).bit_length() + mixcoder.PRIOR_ROOM > mixcoder.FIND_BITS
    for ids in (many, many + mixcoder.DENSE, np.full(9000, 7, "<u4"), np.tile(many[:2], 5000)):
        ids = ids.astype("<u4")
        coded = mixcoder.encode_run(ids)
        assert (mixcoder.decode_run(coded, len(ids)) == ids).all()
    assert 8 * sum(map(len, mixcoder.encode_run(many))) < 18 * len(many) + 8 * len(mixcoder.encode_run(many)[0])


def test_token_files(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    rows = [(None, "first"), (5, None), (4, ""), *((10 + i, t) for i, t in enumerate(odd_texts(4, 60)))]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, start int, ids string").repartition(5)
    folder = scratch_folder(spark, "t-ids")
    token_files.write_token_files(df, folder, BYTE_BPE, file_ids=500)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, folder, with_ids=True).collect()}
    at = 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(got[doc_id]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)
    assert len(got) == len(rows) and spark.read.json(folder + "/manifest").count() > 2
    empty = scratch_folder(spark, "t-ids")
    token_files.write_token_files(df.limit(0), empty, BYTE_BPE)
    assert token_files.read_token_files(spark, empty).count() == 0


# ----------------------------------------------------------------- packing
def fewest(lengths, capacity):
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                bins[k] += lengths[i]
                go(i + 1, bins)
                bins[k] -= lengths[i]
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


def test_bounds_and_best_fit():
    r = random.Random(1)
    for _ in range(200):
        c = r.choice([10, 16, 30])
        lengths = sorted((r.randint(1, c) for _ in range(r.randint(1, 8))), reverse=True)
        bins, _ = packing.best_fit_decreasing(np.array(lengths), c)
        assert packing.lower_bound(np.array(lengths), c) <= fewest(lengths, c) <= bins.max() + 1
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # beyond the plain sum


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    rows = [(i, t) for i, t in enumerate([None, *odd_texts(6, 150)])] + [(3, "repeat"), (3, "repeat"), (None, "n")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, piece int").repartition(3)
    pieces = packing.token_pieces(df, BYTE_BPE, capacity=64)
    out = packing.pack(pieces, capacity=64, part_pieces=60)  # several parts that exchange
    got = out.collect()
    want = []
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cuts(len(ids), 64))]
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(v))]
        assert [o for o, _ in sorted(v)] == ends[:-1] and ends[-1] <= 64
    bound = packing.lower_bound(np.array([r.length for r in got]), 64)
    together = packing.best_fit_decreasing(np.array([r.length for r in got]), 64)[0].max() + 1
    assert bound <= len(by) <= together + 2 * -(-len(got) // 60)  # a part that meets its own bound may round up
    assert packing.pack_documents(df.limit(0), BYTE_BPE).count() == 0
    assert packing.cuts(4096, 2048) == [(0, 2048), (2048, 2048)] and packing.cuts(2049, 2048) == [(0, 1), (1, 2048)]
    assert pieces.select(F.max("length")).first()[0] == 64
