import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import ngram_join, packing, parts, sentencepiece_fst, spotsigs, suffix_dedup, token_counts
from tallybook.llm.blocks import unpack, unpack_sorted
from tests.llm.cases import BASE, TEXTS, documents, prose, rows

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
REPEATED = [None, 3, 3, *range(10, 10 + len(TEXTS) - 3)]


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(texts, size, percent):
    sets = [shingles(t, size) for t in texts]
    name = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both) and name[i] != name[j]:
                low, high = sorted((name[i], name[j]))
                name = [low if n == high else n for n in name]
    return sorted((i, len(s), n) for i, (s, n) in enumerate(zip(sets, name)))


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 50)])
def test_components(spark, size, percent):
    found = ngram_join.ngram_components(documents(spark), size, percent)
    assert sorted(map(tuple, found.collect())) == brute_components(TEXTS, size, percent)


def test_components_of_families(spark, monkeypatch):
    """Families of edited copies, in blocks much smaller than a family."""
    monkeypatch.setattr(ngram_join, "FAMILY_BLOCK", 4)
    rnd = random.Random(8)
    texts = []
    for family in range(4):
        base = [f"w{family}x{rnd.randrange(60)}" for _ in range(80)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(80)] = f"e{rnd.randrange(9)}"
            texts.append(" ".join(copy[: 80 - rnd.randint(0, 6)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, ngram_join.ngram_components(docs).collect())) == brute_components(texts, 4, 85)


def test_components_of_repeated_ids(spark):
    found = ngram_join.ngram_components(documents(spark, REPEATED))
    assert found.count() == len(TEXTS)
    want = brute_components(TEXTS, 4, 85)
    assert sorted(r["n_shingles"] for r in found.collect()) == sorted(n for _, n, _ in want)
    kept = ngram_join.one_per_component(documents(spark, REPEATED), 4, 85)
    assert kept.columns == documents(spark).columns and kept.count() == len({c for _, _, c in want})


def brute_repeats(texts, length):
    seen, out = set(), []
    for i, text in enumerate(texts):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 1])
def test_repeats(spark, hot):
    texts = [t if t is None or len(t) < 30_000 else t[:20_000] + t[500:3_000] for t in TEXTS] + ["ab" * 150, "y" + "ab" * 120]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int").repartition(3)
    found = suffix_dedup.removal_digest(suffix_dedup.remove_repeats(docs, 100, hot_contexts=hot))
    assert sorted(map(tuple, found.collect())) == brute_repeats(texts, 100)


def test_repeats_with_repeated_ids(spark):
    kept = suffix_dedup.without_repeats(documents(spark, REPEATED))
    assert kept.columns == documents(spark).columns and kept.count() == len(TEXTS)
    order = sorted(zip(REPEATED, TEXTS), key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
    want = sorted(n for _, _, n, _, _ in brute_repeats([t for _, t in order], 100))
    got = suffix_dedup.removal_digest(suffix_dedup.remove_repeats(documents(spark, REPEATED)))
    assert sorted(r["n_removed"] for r in got.collect()) == want


def test_repeats_beside_columns_of_any_name(spark):
    docs = documents(spark)
    wide = docs.select("*", F.lit(1).alias("_text"), F.lit(2).alias("_doc"), F.lit(3).alias("_Doc_"), F.lit(4).alias("_key"))
    kept = suffix_dedup.without_repeats(wide)
    assert kept.columns == wide.columns
    assert rows(kept.select(docs.columns)) == rows(suffix_dedup.without_repeats(docs))


def test_rows_sent_are_no_more_than_values():
    """However many buckets there are, ten values make at most ten rows, and all arrive."""
    h = np.arange(1, 11, dtype=np.uint64) % np.uint64(7)
    doc, place = np.arange(10), np.zeros(10, np.int64)
    sent = suffix_dedup._sent(h, h, doc, place, 5000)
    there = [d for c in ("doc", "again_doc") for b in sent.column(c).to_pylist() for d in unpack(b, np.int64).tolist()]
    assert sent.num_rows == 7 and sorted(there) == list(range(10))
    sent = ngram_join._sent(h, doc, 5000)
    assert sent.num_rows == 7
    assert sum(len(unpack_sorted(b)) for c in ("tokens", "several") for b in sent.column(c).to_pylist()) == 7
    assert sum(unpack(b, np.int64).sum() for b in sent.column("counts").to_pylist()) == 6


def test_deep_shallow_order():
    rnd = random.Random(2)
    for _ in range(300):
        head = b"z" * rnd.choice([0, 50, 57])
        texts = [head + bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 20))]
        order, common = suffix_dedup.deep_shallow(texts)
        ranked = [texts[i] for i in order]
        assert ranked == sorted(texts)
        for a, b, n in zip(ranked, ranked[1:], common[1:]):
            assert a[:n] == b[:n] and (a[n : n + 1] != b[n : n + 1] or len(a) == len(b) == n)


def test_packing(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_vocabulary())
    docs = documents(spark)
    packed = packing.pack(docs, length=512, keep_ids=True, group_pieces=8)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(TEXTS):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            piece = struct.pack(f"<{r['length']}I", *ids[at : at + r["length"]])
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece))
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 512
    filled = packing.sequences(packed, 512)
    assert filled.count() == len(by_sequence) and all(len(r["ids"]) == 512 for r in filled.collect())
    assert packing.pack(documents(spark, REPEATED)).agg({"doc_tokens": "count"}).first()[0] >= len(TEXTS)


def test_packing_folds_like_the_vocabulary():
    """Ids where folding the case first, or parting marks from letters, would make other ones."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_vocabulary())
    table = packing.id_table(packing.default_vocabulary())
    for text in [
        "<|EndOfText|> a", "x <|ENDOFTEXT|>.", "<|endoftext|> B", "<|StartOfText|>", "H\u0331a", "T\u0308 H\u0331.", "J\u030c",
        "\u0130.", "\u0958.", "\ufb1d,", "\u03a3\u03a3.", "É É.",
    ]:
        ids, _ = table.gather(*parts.folded_parts(pa.array([text])))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, ascii(text)


def strange_texts(count):
    rnd = random.Random(1)
    letters = [chr(c) for c in range(0x20, 0x2000)] + list("aàéÀÉ'stre<|>endof \n\t\x85\u2009ΣσςİÌ\u0327\u0301") * 30
    letters += ["<|endoftext|>", "<|startoftext|>", "힣", "ᄀ", "ᅡ", "ᆨ", "🎈", "\x1c", "\x00"] * 40
    return ["".join(rnd.choices(letters, k=rnd.randint(0, 14))) for _ in range(count)]


def test_token_counts(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(token_counts.default_vocabulary())
    texts = TEXTS + strange_texts(3_000) + ["a" * 20_000, "ab" * 3_000 + " é" * 2_000, "<|endoftext|>" * 3_000]
    ids = list(range(len(texts) - 2)) + [3, None]
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id long, text string, n_tokens int").repartition(3)
    want = []
    for i, text in zip(ids, texts):
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    assert rows(token_counts.token_counts(docs)) == sorted(want, key=str)
    assert any(over for *_, over in want)


def test_token_counts_and_ids_agree():
    """Ids and counts of very many short texts, by tables that start anew on the way."""
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    texts = strange_texts(40_000)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    counter = token_counts.MergeCounter(path)
    table = parts.PartTable(packing.id_table(path).learn, np.uint32, limit=5_000)
    for start in range(0, len(texts), 1_000):
        some = pa.array(texts[start : start + 1_000])
        assert counter.counts(some).tolist() == [len(ids) for ids in want[start : start + 1_000]]
        ids, bounds = table.gather(*parts.folded_parts(some))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want[start : start + 1_000]


def test_merges_by_plain_rule():
    """The heap and the list give as many merges as looking for the best pair anew each time."""
    counter = token_counts.MergeCounter(token_counts.default_vocabulary())
    rnd = random.Random(3)
    for _ in range(500):
        symbols = [counter.inside[rnd.choice("abeinorst")] for _ in range(rnd.randint(1, 25))]
        left, merges = list(symbols), 0
        while True:
            ranks = [counter.ranks.get(a * counter.width + b, 1 << 30) for a, b in zip(left, left[1:])]
            if not ranks or min(ranks) == 1 << 30:
                break
            at = ranks.index(min(ranks))
            left[at : at + 2] = [counter.merged[ranks[at]]]
            merges += 1
        assert counter.merges(symbols) == merges


def test_token_counts_refuse(tmp_path):
    import json

    with open(token_counts.default_vocabulary(), encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = None
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        token_counts.MergeCounter(str(path))


def test_first_fit():
    rnd = random.Random(1)
    sizes = sorted((rnd.randint(1, 100) for _ in range(300)), reverse=True)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, want = [], []
    for size in sizes:
        at = next((i for i, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(100)
        want.append((at, 100 - room[at]))
        room[at] -= size
    assert list(zip(bins, offsets)) == want


def test_sentencepiece(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.default_model())
    encoded = sentencepiece_fst.encode(documents(spark))
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert got == {i: library.encode(t or "") for i, t in enumerate(TEXTS)}
    decoded = {r["doc_id"]: r["text"] for r in sentencepiece_fst.decode(encoded).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(TEXTS)}
    assert sentencepiece_fst.round_trip(documents(spark, REPEATED)).count() == len(TEXTS)


def test_sentencepiece_weights():
    """A model of weights takes the least sum; bytes only where no piece fits."""
    machine = sentencepiece_fst.Transducer(sentencepiece_fst.default_model(), merges=False)
    machine.pieces = {"a": 0, "b": 1, "ab": 2, "abc": 3, "c": 4}
    machine.weights, machine.longest = {0: 1.0, 1: 1.0, 2: 2.5, 3: 2.9, 4: 0.5}, 3
    machine.starts = {p[:n] for p in machine.pieces for n in range(1, 4)}
    assert machine._shortest("abc") == (0, 1, 4)
    assert len(machine._shortest("aé")) == 3


@pytest.mark.parametrize("kind,settings", [
    ("unigram", {}), ("unigram", {"byte_fallback": True, "normalization_rule_name": "identity", "remove_extra_whitespaces": False}),
    ("unigram", {"add_dummy_prefix": False, "normalization_rule_name": "nmt_nfkc_cf"}), ("bpe", {}),
])
def test_sentencepiece_of_other_models(spark, tmp_path, kind, settings):
    """Kind and normaliser come from the model file."""
    import sentencepiece

    path = str(tmp_path / "small.model")
    with open(path, "wb") as file:
        sentencepiece.SentencePieceTrainer.train(
            sentence_iterator=iter([BASE, prose(3, 200), prose(5, 60)]), model_writer=file, model_type=kind,
            vocab_size=500, hard_vocab_limit=False, minloglevel=2, **settings,
        )
    texts = [t if t is None or len(t) < 9_000 else t[:9_000] for t in TEXTS] + [
        "  the  of ", "Ｔhe ﬁne\u00a0 \u00a8x e\u0301 \u0340", "日日 bad 日", "日", "\u200b", "abcdefg" * 30, "a\tb\r\nc ", "\u2581a \u2581",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = sentencepiece_fst.encode(docs, path)
    want = {i: library.encode(t or "") for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == want
    decoded = {r["doc_id"]: r["text"] for r in sentencepiece_fst.decode(encoded, path).collect()}
    assert decoded == {i: library.decode(ids) for i, ids in want.items()}


def test_sentencepiece_refuses(tmp_path):
    import sentencepiece

    for settings in ({"model_type": "word"}, {"user_defined_symbols": ["<x>"]}, {"treat_whitespace_as_suffix": True}):
        path = str(tmp_path / "small.model")
        with open(path, "wb") as file:
            sentencepiece.SentencePieceTrainer.train(
                sentence_iterator=iter([BASE]), model_writer=file, vocab_size=200, hard_vocab_limit=False, minloglevel=2, **settings
            )
        with pytest.raises(ValueError):
            sentencepiece_fst.Transducer(path)


def test_spot_signatures(spark):
    report = {r["doc_id"]: r for r in spotsigs.edit_report(documents(spark)).collect()}
    texts = [t or "" for t in TEXTS]
    for i, (text, following) in enumerate(zip(texts, texts[1:] + texts[:1])):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = report[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        sets = [spotsigs._batch_sets([t.encode()])[0] for t in (text, edited, following)]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.digest(sets[0]), spotsigs.digest(sets[1]))
        for other, near in ((1, "near_edited"), (2, "near_next")):
            a, b = set(sets[0].tolist()), set(sets[other].tolist())
            assert r[near] == pytest.approx(len(a & b) / len(a | b))
    assert report[5]["fingerprint"] == report[6]["fingerprint"] and report[5]["near_next"] == 1.0
    assert spotsigs.edit_report(documents(spark, REPEATED)).count() == len(TEXTS)


def test_similar_signatures(spark):
    sets = spotsigs.signatures(documents(spark))
    known = {r["doc_id"]: set(r["signatures"]) for r in sets.collect()}
    want = set()
    for a in known:
        for b in known:
            if a < b and known[a] != known[b] and len(known[a] & known[b]) >= 0.8 * len(known[a] | known[b]):
                want.add((a, b))
    got = {(r["a"], r["b"]) for r in spotsigs.similar_pairs(sets, 0.8).collect()}
    assert got == {(a, b) for a, b in want if a not in (6,) and b not in (6,)}


@pytest.mark.parametrize("run", [
    ngram_join.ngram_components, ngram_join.one_per_component, suffix_dedup.remove_repeats, suffix_dedup.without_repeats,
    packing.pack, sentencepiece_fst.round_trip, spotsigs.edit_report, token_counts.token_counts,
])
def test_empty_table(spark, run):
    assert rows(run(documents(spark).limit(0))) == []
