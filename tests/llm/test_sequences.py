"""Token records, periodic runs and tokenizer alignment against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hangarlight.llm import alignment, periodic, queries, subwords, tokenrecords

BYTES, PIECES = (str(public_tokenizers.path(n)) for n in (queries.BYTE_TOKENIZER, queries.TOKENIZER))
ODD = [
    (5, "Hello  world's 12 café\n\n一二 <|endoftext|> x"), (1, None), (2, ""), (3, " "), (None, "no id"), (3, "same id"), (3, "same id"), (-4, "a▁ b ²½"),
    (9, "to be or not " * 700 + "to"), (8, "x" * 3000), (7, "\t tab \r\n " + "ab " * 40), (6, "<s> <0x41> 'ὠ0 \U0001d6fc end "), (10, "\x00 nul"),
]


def frame(spark, rows=ODD, parts=3):
    """Rows with columns that clash with internal names."""
    clash = [F.lit("x").alias(c) for c in ("_digest", "_row", "runs", "a", "n_a", "start", "key")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).select("*", *clash)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


def test_pieces_give_the_librarys_ids(byte_library):
    plain, library = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain.encode_special_tokens = True
    kept, text, pieces = subwords.Encoder(BYTES, most=50), subwords.Encoder(BYTES, True), subwords.Encoder(PIECES, most=50)
    assert kept.exact_cuts and pieces.exact_cuts
    chosen = random.Random(5)
    atoms = [" ", "  ", "\n", "\t", "\r\n", "a", "Hello", "don't", "'s", "12", "²½", "Ⅷ", "一", "▁", "<|endoftext|>", "<s>", "<0x0A>", "\x1c", "\x85", " ", "᠎", "!!", "_", "　", "'LL", "\x00"]
    for _ in range(2000):
        s = "".join(chosen.choice(atoms) for _ in range(chosen.randint(0, 14)))
        assert np.frombuffer(kept.encode(s), kept.dtype).tolist() == byte_library.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(text.encode(s, True), text.dtype).tolist() == plain.encode(" " + s, add_special_tokens=False).ids
        assert np.frombuffer(pieces.encode_spaced(s), pieces.dtype).tolist() == library.encode(s)


def expected_tokens(library, rows):
    """doc_id, start, n_tokens, crc of the records, and their texts' ids; equal ids in any order of texts."""
    out, start = [], 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_records(spark, tmp_path, byte_library):
    path = str(tmp_path / "tokens")
    tokenrecords.write_tokens(frame(spark), path, BYTES, 2, file_bytes=200)
    assert spark.read.parquet(f"{path}/manifest").count() > 4
    back = tokenrecords.read_tokens(spark, path, slice_bytes=100).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    found = sorted(map(tuple, back.collect()), key=lambda r: r[1])
    low = -(10**9)
    digest = {t: frame(spark, [(0, t)]).select(F.xxhash64("text")).first()[0] for i, t in ODD if i == 3}
    order = sorted(ODD, key=lambda r: (low if r[0] is None else r[0], digest.get(r[1], 0)))
    assert found == expected_tokens(byte_library, order)
    index = tokenrecords.read_index(spark, path)
    assert sorted(r.start for r in index.collect()) == [r[1] for r in found]
    mixed = [tokenrecords.read_shuffled(spark, path, seed, 3).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect() for seed in (1, 1, 2)]
    assert all(sorted(map(tuple, m), key=lambda r: r[1]) == found for m in mixed)
    assert mixed[0] == mixed[1] != mixed[2]


def test_token_records_of_no_rows_and_of_damaged_files(spark, tmp_path):
    path = str(tmp_path / "none")
    tokenrecords.write_tokens(frame(spark).limit(0), path, BYTES, 2)
    assert tokenrecords.read_tokens(spark, path).count() == tokenrecords.read_shuffled(spark, path, 1, 2).count() == 0
    path = tmp_path / "damaged"
    tokenrecords.write_tokens(frame(spark, [(1, "some text")], 1), str(path), BYTES, 2)
    file = next(path.glob("*.rec"))
    good = file.read_bytes()
    for at in range(8, len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        if at > 8:
            with pytest.raises(tokenrecords.CorruptRecord):
                tokenrecords.unframe(memoryview(bytes(bad[9:])), 0)
    file.write_bytes(good[:-1])
    with pytest.raises(Exception, match="CorruptRecord"):
        tokenrecords.read_tokens(spark, str(path)).collect()


def brute_runs(words):
    """Stretches of period q, for each q; of equal ones the smallest q."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_generated_words():
    chosen = random.Random(11)
    for _ in range(600):
        documents = []
        for _ in range(chosen.randint(0, 5)):
            words, letters = [], chosen.choice([1, 2, 2, 3, 5])
            while len(words) < chosen.randint(0, 80):
                if chosen.random() < 0.4 and words:
                    a = chosen.randrange(len(words))
                    words += words[a : a + chosen.randint(1, 20)] * chosen.randint(1, 8)
                else:
                    words.append(bytes([97 + chosen.randrange(letters)]))
            documents.append(words)
        assert periodic.runs_of(documents) == [brute_runs(w) for w in documents]


def expected_periodic(i, text):
    words = periodic._WORD.findall((text or "").encode())
    n, h = len(words), zlib.crc32(str(i).encode())
    if i is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + m for s, m, q in runs)]
    digests = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode(), b" ".join(kept))]
    return (i, len(runs), *best, None if not runs else 1000 * best[1] // best[2], *digests)


def test_periodic_runs_query(spark, tmp_path):
    chosen = random.Random(2)
    many = [(100 + k, " ".join(chosen.choice(["a", "b", "cé", "\U0001d6fc"]) for _ in range(chosen.randint(0, 60)))) for k in range(200)]
    frame(spark, ODD + many).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == Counter(expected_periodic(*r) for r in ODD + many)
    assert sum(expected_periodic(*r)[1] > 0 for r in many) > 10
    assert periodic.periodic_runs(frame(spark).limit(0)).count() == 0


def brute_alignment(byte_library, rows):
    plain, library = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain.encode_special_tokens = True
    decode = {ord(c): b for b, c in subwords.byte_characters().items()}
    made, held = [], Counter()
    for i, text in rows:
        a, b = (plain.encode(" " + text, add_special_tokens=False).ids, library.encode(text)) if text else ([], [])
        spelt = [[bytes(decode[ord(c)] for c in plain.id_to_token(k)) for k in a], [subwords._piece_bytes(library.id_to_piece(k)) for k in b]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelt):
            a, b, spelt = [], [], [[], []]
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelt]
        spans = [list(zip([0, *e[:-1]], e, ids, strict=True)) if ids else [] for e, ids in zip(ends, (a, b), strict=True)]
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if max(x[0], y[0]) < min(x[1], y[1])]
        low, groups = 0, []
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(k) for s, e, k in side if low <= s < cut) for side in spans))
            low = cut
        made.append((i, len(a), len(b), groups, links))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    digest = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""
    return [(i, n, m, len(g), len(k), sum(held[p] == best[p[0]] for p in k), sum(held[p] for p in k), digest(g)) for i, n, m, g, k in made]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query_and_cold_pairs(spark, tmp_path, byte_library):
    rows = [r for r in ODD if len(r[1] or "") < 2500] + [(20, "to be or not to be café"), (21, "be not unbelievable"), (22, "Unbelievable 12 unbelievably")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = Counter(brute_alignment(byte_library, rows))
    assert Counter(map(tuple, queries.op13_tokenizer_alignment(spark, str(tmp_path)).select(*COLUMNS).collect())) == wanted
    aligned = alignment.align(spark.read.parquet(str(tmp_path / "documents.parquet")), BYTES, PIECES)
    aligned.write.parquet(str(tmp_path / "aligned"))
    stored = spark.read.parquet(str(tmp_path / "aligned"))
    for most in (0, 3, 40):  # all, most and some pairs go through the join
        scored = alignment.score_links(stored, most).withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
        assert Counter(map(tuple, scored.select(*COLUMNS).collect())) == wanted
    assert alignment.score_links(stored.limit(0)).count() == 0


def test_bitset_ranks():
    chosen = np.random.default_rng(1)
    places = np.unique(chosen.integers(0, 1000, 300))
    bits = alignment.Bitset.of(places, 1000)
    assert bits.select().tolist() == places.tolist()
    assert bits.rank(np.arange(1001)).tolist() == [int((places < k).sum()) for k in range(1001)]
