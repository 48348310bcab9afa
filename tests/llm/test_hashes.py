"""Texts chosen so that hashes with public constants clash must be told apart."""


import numpy as np
import pyarrow as pa
import pytest

from goldpan.llm import decontaminate, jaccard_join, lm_scoring, minhash, rolling, substring_dedup, token_records
from goldpan.llm.queries import tokenizer_path
from goldpan.llm.rolling import U, mix, strings, windows

#: One hash under h = mix(mix(first eight bytes) ^ next eight bytes) without a key.
PAIR = ("qw7b3pdkhx4py8gp", "udj7tsc1ulj611eh")
#: The low 44 bits of their unkeyed hashes agree, so patterns of the two clash modulo 2**64.
LOW = ("v33qm1q", "0ha0dbs")


def solved(size):
    """Two strings of ``size`` bytes that the unkeyed hash takes for one: the second block makes up for the first."""
    r = np.random.Generator(np.random.PCG64(size))
    a, b = (r.integers(0, 256, size, dtype=np.uint8) for _ in range(2))
    b[16:] = a[16:]
    eight = lambda x, i: np.frombuffer(x[i : i + 8].tobytes(), "<u8").astype(U)
    state = lambda x: mix(eight(x, 0) ^ (U(size) << U(56)))
    b[8:16] = np.frombuffer((eight(a, 8) ^ state(a) ^ state(b)).astype("<u8").tobytes(), np.uint8)
    return a, b


@pytest.mark.parametrize("size", [16, 17, 40])
def test_solved_strings_differ_under_any_key(size):
    a, b = solved(size)
    data, ends = np.concatenate((a, b)), np.array([size, 2 * size])
    for secret in (b"one key" * 4, b"another key" * 2):
        before = rolling._key.secret
        rolling.use(secret)
        x, y = strings(data, ends - size, ends)
        rolling.use(before)
        assert x != y


def test_keys_change_hashes_and_travel_with_tasks():
    data = np.frombuffer(b"some words", np.uint8)
    hashed = lambda _: strings(data, np.array([0]), np.array([10]))[0]
    before = rolling._key.secret
    task = rolling.keyed(hashed)
    own = hashed(None)
    rolling.use(b"x" * 32)
    assert hashed(None) != own and task(None) == own
    rolling.use(before)


@pytest.mark.parametrize("length", [1, 2, 5, 24, 50, 64])
def test_windows_are_polynomials_modulo_a_prime(length):
    symbols = np.random.Generator(np.random.PCG64(length)).integers(0, 2**64, 20_000, dtype=U)
    got, p = windows(symbols, length), rolling.PRIME
    assert len(got) == len(symbols) - length + 1 and not len(windows(symbols[:3], 50))
    for at in (0, 8150, 8191, 8192, len(got) - 1):
        want = 0
        for s in symbols[at : at + length].tolist():
            want = (want * rolling._key.prime_base + s) % p
        assert int(got[at]) == want


def pattern(a, b):
    """The two words in Thue and Morse's order, 32 of them, and in the opposite order; then the same 18 words."""
    x, y = [a], [b]
    for _ in range(5):
        x, y = x + y, y + x
    rest = [f"common{i}" for i in range(18)]
    return " ".join(x + rest), " ".join(y + rest)


def test_windows_of_two_words_in_opposite_orders_differ(spark):
    for words in (LOW, PAIR):
        x, y = pattern(*words)
        docs = spark.createDataFrame([(1, x), (2, y), (3, x), (4, y)], "doc_id long, text string")
        assert {r.doc_id: r.n_removed for r in substring_dedup.dedup_windows(docs).collect()} == {1: 0, 2: 0, 3: 50, 4: 50}


def test_words_with_one_unkeyed_hash_differ(spark):
    a, b = PAIR
    own = [f"w{i}" for i in range(60)]
    with_ = lambda x: " ".join([*own[:20], x, *own[20:]])
    docs = spark.createDataFrame([(1, a), (2, b), (3, with_(a)), (4, with_(b))], "doc_id long, text string")
    alone = docs.filter("doc_id < 3")
    assert {r.doc_id: r.component_id for r in jaccard_join.link_documents(alone, n=3, num=90, den=100).collect()} == {1: 1, 2: 2}
    assert {r.doc_id: r.component_id for r in minhash.link_documents(alone).collect()} == {1: 1, 2: 2}
    assert {r.doc_id: r.n_removed for r in substring_dedup.dedup_windows(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    items = spark.createDataFrame([(7, with_(a).split(" ", 15)[-1])], "item_id long, text string")
    hits = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.find_overlaps(docs, items).collect()}
    assert hits[3] == (46, ["7"]) and hits[4][0] == 40 and hits[1] == hits[2] == (0, [])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    bits = {r.doc_id: r.target_bits for r in lm_scoring.score(alone, labels).collect()}
    assert bits[1] < bits[2]


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_pieces_with_one_unkeyed_hash_have_ids_of_their_own(order):
    from tokenizers import Tokenizer

    encode, plain = token_records.Encoder(tokenizer_path(), 0, "<u2", True), Tokenizer.from_file(tokenizer_path())
    for i in order:
        for text in (PAIR[i], f"one {PAIR[i]} two", f" {LOW[i]}"):
            assert encode(pa.array([text])) == [np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u2").tobytes()]


def test_rows_alike_go_to_several_shards(spark, tmp_path):
    """One repeated row holds nearly all of the corpus: no shard has more than its share."""
    rows = [(7, "the same words again and again")] * 900 + [(None, "no id")] * 60 + [(i, f"text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = str(tmp_path / "tokens")
    manifest = token_records.write_records(docs, path, tokenizer_path=tokenizer_path(), shard_bytes=3000)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 1000 and len(sizes) > 5 and max(sizes) < 300
    back = token_records.read_records(manifest, path).orderBy("start").collect()
    assert [r.doc_id for r in back] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    ends = [r.start + r.n_tokens for r in back]
    assert [r.start for r in back] == [0, *ends[:-1]]


def test_paths_are_those_of_spark(spark, tmp_path):
    for path in (f"{tmp_path}/x y", f"file:{tmp_path}/x y", f"file://{tmp_path}/x y"):
        assert token_records.arrow_uri(spark, path) == f"file://{tmp_path}/x%20y"


def test_pieces_whose_hashes_clash_are_told_apart(monkeypatch):
    """Whatever the hash: here all pieces of one length share it."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_records, "pieces", lambda data, start, end: (end - start).astype(U))
    encode, plain = token_records.Encoder(tokenizer_path(), 0, "<u2", True), Tokenizer.from_file(tokenizer_path())
    for texts in (["one two six", "ten red fox", "", "é  x\n"], ["red two one", "one two six"]):
        want = [np.array(plain.encode(t, add_special_tokens=False).ids + [0], "<u2").tobytes() for t in texts]
        assert encode(pa.array(texts)) == want


def _ids(tokenizer, text: str) -> bytes:
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u2").tobytes()


def test_words_are_learnt_once_whatever_stands_beside_them():
    encode = token_records.Encoder(tokenizer_path(), 0, "<u2", True)
    words, signs = [f"w{x}ord" for x in "abcdefghijklmnopqrst"], ["", ".", ",", "!!", "###", "?\n", ".\nA", "7"]
    texts = [" ".join(f"é{w}{s}" for w in words) for s in signs]
    assert encode(pa.array(texts)) == [_ids(encode.tokenizer, t) for t in texts]
    assert len(encode.known) < 2 * len(words) + 3 * len(signs)


def test_a_full_memory_keeps_what_is_met_most(monkeypatch):
    monkeypatch.setattr(token_records, "CACHE_PIECES", 60)
    encode, learnt = token_records.Encoder(tokenizer_path(), 0, "<u2", True), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda hashes, *rest: (learnt.append(len(hashes)), learn(hashes, *rest)))
    common = " ".join(f"{a}{b}" for a in "abcd" for b in "mnop")
    for i in range(40):
        text = f"{common} " + " ".join(f"{a}{b}x" for a in "qrst" for b in [chr(97 + i % 26) * (i // 26 + 1)])
        assert encode(pa.array([text])) == [_ids(encode.tokenizer, text)]
        assert len(encode.known) <= 60 + 20
    assert len(learnt) == 40 and sum(learnt) == 16 + 40 * 4  # the common words once only


def test_pieces_of_random_texts_have_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_records, "CACHE_PIECES", 500)
    encode = token_records.Encoder(tokenizer_path(), 0, "<u2", True)
    parts = [*"aAzst'\"’.,!<|>09 \t\n\r\v\x00\x1c\x7f", "  ", "\n\n", "\r\n", "'s", "'re", "<|endoftext|>", "<|endof", "text|>", "é", "×", "÷", "ß", "ȿ", "ɀ", "\u0301", "\u00a0", "\u0085", "\u2028", "²", "—", "日", "🙂", "the"]
    draw = np.random.Generator(np.random.PCG64(9))
    for _ in range(30):
        texts = ["".join(parts[k] for k in draw.integers(0, len(parts), n)) for n in draw.integers(0, 14, 200)]
        assert encode(pa.array(texts)) == [_ids(encode.tokenizer, t) for t in texts]
    signs = [chr(c) for c in range(0x3100) if not chr(c).isalnum() or c < 0x300]
    texts = [f"a{c}b {c} 1{c}2\n{c}'s" for c in signs]
    assert encode(pa.array(texts)) == [_ids(encode.tokenizer, t) for t in texts]


def test_tokenizers_that_look_beyond_words_get_whole_texts(tmp_path):
    from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

    assert token_records._is_byte_level(tokenizer_path())
    changes = (
        lambda t: setattr(t, "normalizer", normalizers.NFC()),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)),
        lambda t: t.add_tokens([AddedToken("<x>", rstrip=True)]),
        lambda t: t.add_tokens([AddedToken("<x y>")]),
        lambda t: t.add_tokens([AddedToken("tok")]),
    )
    for i, change in enumerate(changes):
        other = Tokenizer.from_file(tokenizer_path())
        change(other)
        other.save(str(tmp_path / f"{i}.json"))
        assert not token_records._is_byte_level(str(tmp_path / f"{i}.json"))
