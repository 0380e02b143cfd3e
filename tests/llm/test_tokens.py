"""BPE by tree reduction and prefix counts, against the libraries."""

import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from foliospark.llm import bpe_tree, token_counts  # noqa: E402
from odd_rows import ODD  # noqa: E402

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "  ", "'", "'re", "'ll", "l", "'''", "\n", "\t", "é", "1", "!", " the", " and", "日", "##", "\x1c", " ", "xyz" * 20]


def texts(seed, count, longest):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_tree.load_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("chars", [2, 3, 7])
@pytest.mark.parametrize("size", [2, 5])
def test_tree_with_tiny_leaves_gives_the_library_ids(monkeypatch, library, chars, size):
    monkeypatch.setattr(bpe_tree, "LEAF_CHARS", chars)
    monkeypatch.setattr(bpe_tree, "LEAF_BYTES", size)
    encoder = bpe_tree.TextEncoder(bpe_tree.BytePairs(bpe_tree.load_ranks(RANKS)), P.PATTERN)
    for text in texts(chars, 800, 40):
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_long_pieces(library):
    encoder = bpe_tree.encoder(RANKS, P.PATTERN)
    rnd = random.Random(5)
    for text in ["ab" * 4000, "".join(rnd.choice("abcdefgh") for _ in range(8000)), " " * 3000, "日本" * 1500]:
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_join_is_associative_and_right():
    pairs = bpe_tree.BytePairs(bpe_tree.load_ranks(RANKS))
    rnd = random.Random(8)
    for _ in range(500):
        a, b, c = ("".join(rnd.choice(["th", "e", "ing", "tion", "é", "x"]) for _ in range(rnd.randrange(8))).encode() for _ in range(3))
        ea, eb, ec = (pairs.merged(x) if x else [] for x in (a, b, c))
        whole = pairs.merged(a + b + c) if a + b + c else []
        assert pairs.join(pairs.join(ea, eb), ec) == pairs.join(ea, pairs.join(eb, ec)) == whole


def test_encode_and_decode_odd_rows(odd, nothing, library):
    done = bpe_tree.decode_ids(bpe_tree.encode_texts(odd, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert done.columns.count("token_ids") == 1
    rows = done.select("text", "token_ids", "decoded", "size").collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["size"] == "s"
    assert bpe_tree.encode_texts(nothing, RANKS, P.PATTERN).count() == 0


def test_decoding_in_the_task_that_encodes(odd):
    """One Python worker for each task does both, with the results of the two steps."""
    two = bpe_tree.decode_ids(bpe_tree.encode_texts(odd, RANKS, P.PATTERN), RANKS, P.PATTERN)
    one = bpe_tree.encode_texts(odd, RANKS, P.PATTERN, decoded="decoded", remember=False)
    assert one.schema == two.schema
    key = ["doc_id", "text", "token_ids", "decoded"]
    assert sorted((repr(r) for r in one.select(key).collect())) == sorted((repr(r) for r in two.select(key).collect()))


def test_forgetting_all(library):
    encoder = bpe_tree.TextEncoder(bpe_tree.BytePairs(bpe_tree.load_ranks(RANKS)), P.PATTERN)
    for text in texts(9, 50, 40):
        encoder.encode(text)
    assert encoder.known and encoder.pairs.subtrees and encoder.pairs.seams
    encoder.forget()
    assert not encoder.known and encoder.pairs.subtrees
    encoder.forget(all_=True)
    assert not encoder.pairs.subtrees and not encoder.pairs.seams
    for text in texts(9, 50, 40):
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_prefix_counts_of_every_prefix():
    library = tokenizers.Tokenizer.from_file(JSON)
    counter = token_counts.counter(JSON, P.PATTERN)
    rnd = random.Random(4)
    for _ in range(700):
        text = "".join(rnd.choice([*PIECES[:-1], "<|endoftext|>", "<|end"]) for _ in range(rnd.randrange(12)))
        want = [len(e.ids) for e in library.encode_batch([text[:i] for i in range(1, len(text) + 1)], add_special_tokens=False)]
        assert counter.prefixes(text).tolist() == want


def test_counts_budgets_and_tables_of_odd_rows(odd, nothing):
    library = tokenizers.Tokenizer.from_file(JSON)
    counted = token_counts.count_tokens(odd, JSON, P.PATTERN, budget=4).collect()
    tables = {r["text"]: r["prefix_tokens"] for r in token_counts.prefix_tables(odd, JSON, P.PATTERN).collect()}
    want = sorted((d or -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in ODD)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in counted) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4) for r in counted)
    fitting = {r["doc_id"]: r["fitting_chars"] for r in counted}
    first = ODD[0][1]
    longest = max(i for i in range(len(first) + 1) if len(library.encode(first[:i]).ids) <= 4)
    assert fitting[1] == longest == token_counts.fits(__import__("numpy").array(tables[first]), 4)
    assert tables[None] == [] and token_counts.count_tokens(nothing, JSON, P.PATTERN).count() == 0


def test_borders_by_undone_merges_are_those_of_the_encoding():
    counter = token_counts.counter(JSON, P.PATTERN)
    rnd, tokens = random.Random(3), sorted(counter.tokens)
    short = [t for t in tokens if len(t) <= 3]
    pairs = [(rnd.choice(x), rnd.choice(x)) for x in (tokens, short) for _ in range(3000)] + [(t, t) for t in short[:500]]
    pairs += [(t[:k], t[k:]) for t in tokens[::50] for k in range(1, len(t)) if t[:k] in counter.tokens and t[k:] in counter.tokens]
    for a, b in pairs:
        assert counter.is_stable(a, b) == (counter.merged(a + b) == [a, b])


def test_long_pieces_have_whole_tables():
    counter = token_counts.counter(JSON, P.PATTERN)
    own = tokenizers.Tokenizer.from_file(JSON)
    for text in ["ab" * 3000, " " * 3000, "日本" * 700]:
        table = counter.prefixes(text)
        assert len(table) == len(text) and table[-1] == len(own.encode(text, add_special_tokens=False).ids)


def test_most_documents_are_joined_from_subtrees(spark):
    from foliospark.llm.common import table

    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect() if r["text"]]
    joined = 0
    for text in texts:
        encoder = bpe_tree.TextEncoder(bpe_tree.BytePairs(bpe_tree.load_ranks(RANKS)) if not joined else encoder.pairs, P.PATTERN)
        before = encoder.pairs.joins
        encoder.encode(text)
        joined += encoder.pairs.joins > before
    assert 2 * joined > len(texts)


def test_queries_give_what_the_libraries_give(spark, library):
    import hashlib

    from foliospark.llm.common import table
    from foliospark.llm.queries import QUERIES

    where = "/root/testdata/sf0.001"
    own = tokenizers.Tokenizer.from_file(JSON)
    op2, op5 = [], []
    for r in table(spark, where, "documents").select("doc_id", "text").collect():
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        op2.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        n = len(own.encode(text, add_special_tokens=False).ids)
        op5.append((r["doc_id"], len(text.encode()), n, n > 512))
    assert sorted(map(tuple, QUERIES["op2_bpe_tree"](spark, where).collect())) == sorted(op2)
    assert sorted(tuple(r)[:4] for r in QUERIES["op5_token_counts"](spark, where).collect()) == sorted(op5)


def test_lists_of_ids_are_decoded_together():
    """One take of all tokens for a batch, whose bytes already stand one after the other; also for parts of a batch and null lists."""
    pa = pytest.importorskip("pyarrow")
    encoder = bpe_tree.TextEncoder(bpe_tree.BytePairs(bpe_tree.load_ranks(RANKS)), P.PATTERN)
    some = [*texts(13, 40, 30), None, "", "日本 the" * 900]
    ids, tokens = encoder.encode_all(some), encoder.pairs.tokens
    assert [bytes(b).decode() for b in bpe_tree.decode(tokens, ids).to_pylist()] == [t or "" for t in some]
    assert ids.to_pylist() == [encoder.encode(t) if t else [] for t in some]
    lists = pa.array([[5], None, [], [1, 2, 3], None, [4]], pa.list_(pa.int32()))
    want = [None if x is None else b"".join(encoder.pairs.token[k] for k in x) for x in lists.to_pylist()]
    for a in range(7):
        for b in range(a, 7):
            assert bpe_tree.decode(tokens, lists.slice(a, b - a)).to_pylist() == want[a:b]
    for bad in ([[1, None]], [[10**6]]):
        with pytest.raises((KeyError, IndexError)):
            bpe_tree.decode(tokens, pa.array(bad, pa.list_(pa.int32())))
