import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewater.llm import queries, tokencount

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    """Greedy longest match, piece by piece, on the library's own words."""
    t = Tokenizer.from_file(FILE)
    vocabulary = set(t.get_vocab()) - {"<|startoftext|>", "<|endoftext|>"}

    def count(text):
        words = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        total = 0
        for w, _ in words:
            i = n = 0
            while i < len(w):
                j = next((j for j in range(len(w), i, -1) if w[i:j] + ("</w>" if j == len(w) else "") in vocabulary), None)
                if j is None:
                    n = 1
                    break
                i, n = j, n + 1
            total += n
        return len(words), total

    return count


def test_query_matches_greedy_pieces(spark, plain):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in queries.read(spark, sf, "documents").collect()}
    rows = queries.op9_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in rows} == {k: plain(t) for k, t in texts.items()}


def test_odd_texts(plain):
    rnd = random.Random(2)
    signs = [*"ab1 '\n.!stmdrevlAB", "É", "é", "日", "😀", "²"]
    texts = ["", " ", "a" * 3000, *("".join(rnd.choice(signs) for _ in range(rnd.randint(1, 14))) for _ in range(500))]
    words, tokens = tokencount.WordCounter(FILE).count(texts)
    assert list(zip(words.tolist(), tokens.tolist(), strict=True)) == [plain(t) for t in texts]


def test_pieces_that_begin_and_continue():
    a = tokencount.Automaton([tuple("a"), tuple("abcd")], [tuple("b"), tuple("bc"), tuple("z")])
    assert [a.count(x) for x in ("abcz", "abcd", "abcdz", "abz", "q", "aq", "", "a", "abc", "abcdb")] == [3, 1, 2, 3, 1, 1, 0, 1, 2, 2]


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 8), (2, "", 8), (None, "cat", 7)], "doc_id long, text string, n_tokens long")
    assert sorted((str(r.doc_id), r.n_tokens) for r in tokencount.token_counts(df, FILE, ["doc_id"]).collect()) == [("1", 0), ("2", 0), ("2", 0), ("None", 1)]
    assert tokencount.token_counts(df.limit(0), FILE, ["doc_id"]).count() == 0
