import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, clashing, frame, ordered

from postflow.llm.chunks import ChunkMemory, byte_bpe
from postflow.llm.sentence_pieces import PieceLattice, decode_pieces, encode_pieces, merged, piece_model
from postflow.llm.token_counts import attribute, line_starts, section_tokens
from postflow.llm.token_files import index_of, pack, token_file_round_trip, unpack, unpack_range

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = "ab cd  \n\t'sé漢🤗 \xa0　\x1c1.,<|endoftext|>▁the in"


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_chunked_ids_and_spans_are_those_of_whole_texts(corpus):
    texts = odd_texts(1500) + [t for _, t in corpus] + ["x" * 5000, " " * 3000, ""]
    encoder = byte_bpe(BPE)
    count, ids, start, end = encoder.encode_spans(texts)
    ends = np.cumsum(count)
    for text, want, a, b in zip(texts, encoder.tokenizer.encode_batch(texts, add_special_tokens=False), ends - count, ends):
        assert want.ids == ids[a:b].tolist()
        assert want.offsets == list(zip(start[a:b].tolist(), end[a:b].tolist()))
    assert encoder.encode(texts)[1].tolist() == ids.tolist()


def test_memory_forgets_and_stays_right():
    memory = ChunkMemory(lambda new: (new, np.array([len(c) for c in new]), [np.array([ord(x) for c in new for x in c])]), 1, most_chunks=3)
    for words in (["ab", "c"], ["c", "de", "ab"], ["f", "g", "h", "ab"], ["c", "c"]):
        count, (flat,) = memory.rows(words)
        assert flat.tolist() == [ord(x) for w in words for x in w] and count.tolist() == [len(w) for w in words]


@pytest.mark.parametrize("values", [
    [], [0] * 500, [1, 2, 3], [0] * 130 + [2**63] + [5] * 7 + [2**60 - 1, 2**60] + list(range(300)), [2 ** (i % 64) for i in range(500)],
    random.Random(1).choices(range(50_000), k=5000),
])
def test_words_unpack_to_what_was_packed(values):
    values = np.array(values, np.uint64)
    words, wide = pack(values)
    assert unpack(words, len(values), wide).tolist() == values.tolist()
    for first, n in ((0, len(values)), (len(values) // 3, len(values) // 2)):
        assert unpack_range(words, index_of(words), first, n, wide).tolist() == values[first : first + n].tolist()


def test_token_files_hold_what_the_library_encodes(spark):
    docs, rows = awkward(spark, odd_texts(40))
    got = token_file_round_trip(clashing(docs), BPE, end_id=0, files=3, block_chars=500)
    tokenizer = byte_bpe(BPE).tokenizer
    want, at = [], 0
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert ordered((r.id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()) == ordered(want)
    assert token_file_round_trip(docs.limit(0), BPE).count() == 0


def test_ids_come_back(spark):
    from postflow.llm.token_files import read_token_files, write_token_files
    from postflow.session import run_folder

    folder = run_folder(spark, "ids")
    write_token_files(frame(spark, [(2, "two"), (1, "one more")]), folder, BPE, end_id=7)
    got = {r.id: list(r.ids) for r in read_token_files(spark, folder, with_ids=True).collect()}
    assert got == {k: [*byte_bpe(BPE).tokenizer.encode(t).ids, 7] for k, t in ((1, "one more"), (2, "two"))}


def test_pieces_equal_the_library(spark, corpus):
    texts = odd_texts(800) + [t for _, t in corpus] + ["in" * n for n in range(40)] + [" " * n for n in range(40)] + ["thein" * 2000]
    model = piece_model(MODEL)
    count, ids = model.encode(texts)
    ends = np.cumsum(count)
    for text, want, a, b in zip(texts, model.model.encode(texts), ends - count, ends):
        assert want == ids[a:b].tolist()
        assert model.decode(want) == model.model.decode(want)


def trained(rng, n):
    """Pieces as training makes them: the most frequent adjacent pair of a text is joined, again and again."""
    names, texts = list("abc"), [[rng.choice("aabbc") for _ in range(40)] for _ in range(20)]
    while len(names) < n:
        pairs = Counter(p for t in texts for p in zip(t, t[1:]) if p[0] + p[1] not in names)
        if not pairs:
            break
        names.append("".join(pairs.most_common(1)[0][0]))
        rank = {m: i for i, m in enumerate(names[3:])}
        texts = [merged(list("".join(t)), rank)[0] for t in texts]
    return names


def test_lattice_equals_merging():
    rng = random.Random(4)
    for _ in range(25):
        names = trained(rng, 25)
        lattice = PieceLattice(names, [-float(i) for i in range(len(names))])
        rank = {n: i for i, n in enumerate(names[3:])}
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(60)]
        count, found = lattice.segment(texts)
        ends = np.cumsum(count)
        for text, a, b in zip(texts, ends - count, ends):
            assert [lattice.names[i] for i in found[a:b]] == merged(list(text), rank)[0]


def test_pieces_before_their_parts_are_refused():
    with pytest.raises(ValueError):
        PieceLattice(["a", "b", "ab", "abb"], [0, 0, -2, -1])


def test_encoded_table_decodes_to_its_texts(spark):
    docs, rows = awkward(spark, [t.replace("▁", "") for t in odd_texts(60)])
    encoded = encode_pieces(clashing(docs), MODEL)
    got = encoded.collect()
    assert all(r.same for r in got) and len(got) == len(rows)
    assert ordered((r.id, r.n_ids) for r in got) == ordered((r[0], len(piece_model(MODEL).model.encode(r[1] or ""))) for r in rows)
    back = decode_pieces(encoded, MODEL).collect()
    assert ordered((r.id, r.text) for r in back) == ordered((r[0], r[1] or "") for r in rows)
    assert encode_pieces(docs.limit(0), MODEL).count() == 0
    assert [r.text for r in decode_pieces(spark.createDataFrame([(1, 1, None), (2, 2, [])], "row long, id long, ids array<int>"), MODEL).orderBy("id").collect()] == [None, ""]


def plain_sections(text, starts):
    """Section of each token by counting characters one by one."""
    bounds = [*starts, len(text)]
    section = [max(i for i, s in enumerate(starts) if s <= c) for c in range(len(text))] if text else []
    total, crossing = [0] * len(starts), [0] * len(starts)
    for a, b in byte_bpe(BPE).tokenizer.encode(text, add_special_tokens=False).offsets:
        own = [section[c] for c in range(a, b)]
        best = max(sorted(set(own)), key=own.count)
        total[best] += 1
        crossing[best] += len(set(own)) > 1
    return list(zip(starts, bounds[1:], total, crossing))


def test_section_counts_equal_counting_characters(spark):
    texts = ["a\n\n\nb", "one\ntwo three\n", "\n\n", "x \n  y", *odd_texts(60)]
    docs = frame(spark, [*enumerate(texts), (None, None), (99, "")])
    got = {}
    for r in section_tokens(clashing(docs.withColumn("lang", docs.text)), BPE).collect():
        got.setdefault(r.id, []).append((r.section, r.char_start, r.char_end, r.n_tokens, r.n_crossing))
    for i, text in [*enumerate(texts), (None, ""), (99, "")]:
        assert [x[1:] for x in sorted(got[i])] == plain_sections(text, line_starts(text).tolist())
    assert section_tokens(docs.limit(0), BPE).count() == 0


def test_fields_share_one_encoding(spark):
    docs = spark.createDataFrame([(1, "Title", "body text\nmore", None)], "doc_id long, title string, text string, note string")
    got = section_tokens(docs, BPE, fields=("title", "note", "text"), lines=False).orderBy("char_start", "char_end").collect()
    joined = "Title\n\n\n\nbody text\nmore"
    assert [(r.field, r.char_start, r.char_end) for r in got] == [("title", 0, 7), ("note", 7, 9), ("text", 9, len(joined))]
    assert sum(r.n_tokens for r in got) == len(byte_bpe(BPE).tokenizer.encode(joined).ids)


def test_ties_go_to_the_first_section():
    owner, crossing = attribute(np.array([0, 2, 4]), np.array([2, 6, 9]), np.array([4, 5, 9]))
    assert owner.tolist() == [0, 0, 2] and crossing.tolist() == [False, True, True]


def test_spelt_special_tokens_are_what_the_library_makes_of_them(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["text <|endoftext|> more", "<|endoftext|>", "plain", "<|endoftext", "a<|endoftext|><|endoftext|>b"]
    found = {r["id"]: r["n_tokens"] for r in token_file_round_trip(frame(spark, list(enumerate(texts))), path).collect()}
    library = Tokenizer.from_file(path)
    assert found == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_stretches_are_those_of_the_pattern():
    """Borders found on all characters at once are those a pattern finds text by text."""
    import random
    import re

    from postflow.llm import chunks

    space = chunks._SPACE
    pattern = re.compile(f" ?[^\\W\\d_]++(?=[!-/:-@[-`{{-~])| ?[^{space}]+|[{space}]+(?![^{space}])|[{space}]+")
    rng = random.Random(1)
    letters = ["a", "b", "É", "²", "1", "_", " ", " ", "\n", "\t", ".", ",", "'", "\u3000", "\xa0", "😀", "\u200b", "-", "\x1c"]
    for _ in range(200):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 12))]
        cut = chunks.stretches(texts)
        flat, ends = [cut.distinct[k] for k in cut.which], np.cumsum(cut.parts)
        assert [flat[e - n : e] for e, n in zip(ends, cut.parts)] == [pattern.findall(t) for t in texts]
        assert cut.width.tolist() == [len(x) for x in flat] and len(set(cut.distinct)) == len(cut.distinct)


def test_texts_of_a_batch_become_strings_part_by_part():
    import tracemalloc

    import pyarrow as pa

    from postflow.llm.chunks import text_parts

    column = pa.array(["x" * (1 << 20), None, "é" * 10, ""] * 48).slice(3)
    tracemalloc.start()
    seen = [(a, b, [len(t) for t in texts]) for a, b, texts in text_parts(column)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [n for _, _, own in seen for n in own] == [len(t or "") for t in column.to_pylist()]
    assert [a for a, _, _ in seen] == [0, *(b for _, b, _ in seen[:-1])] and seen[-1][1] == len(column)
    assert most < 8 << 20
