import llm_data as D
import public_tokenizers

from saleswh.llm import queries, tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, scores, byte):
    """Best (score, fewest pieces) by a table over all prefixes of one word."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * byte, best[end - 1][1] + size)]
        options += [(best[b][0] + scores[word[b:end]], best[b][1] + 1) for b in range(end) if word[b:end] in scores]
        top = max(s for s, _ in options)
        best.append((top, min(n for s, n in options if s == top)))
    return best[-1][1]


def test_counts_equal_brute_force(spark):
    scores, byte = tokens.pieces(PATH)
    rows = [(1, None), (2, ""), (3, " \n "), (4, "hello hello world"), (5, "中文 😀é\u00a0x"), (6, "x" * 3000), (7, D.sentences(1, 20000)), (4, "hello hello world"), (None, "a b")]
    got = tokens.counted(D.frame(spark, rows).selectExpr("*", "'old' as n_tokens"), PATH).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        w = (t or "").encode().split()
        want[i] = (len(w), sum(n * brute(tokens.MARK + x.decode(), scores, byte) for x, n in {x: w.count(x) for x in set(w)}.items()))
    for r in got:
        assert (r.n_pretokens, r.n_tokens) == want[r.doc_id]
    assert tokens.counted(D.frame(spark, rows).limit(0), PATH).count() == 0


def test_prefixes_are_scored_once():
    trie = tokens.Trie({"a": -1.0, "ab": -1.5, "b": -1.0, "abc": -9.0}, -5.0)
    assert trie.count("ab") == 1 and len(trie.score) == 3
    assert trie.count("abab") == 2 and trie.count("abb") == 2 and len(trie.score) == 6
    assert trie.count("abx") == 2 and trie.count("é") == 2
    trie.clear()
    assert trie.count("abab") == 2 and len(trie.score) == 5


def test_query_digest(spark):
    scores, byte = tokens.pieces(PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{D.SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op3_token_counts"](spark, D.SMALL).collect()
    assert len(got) == len(docs)
    for r in got[:40]:
        assert r.n_tokens == sum(brute(tokens.MARK + x.decode(), scores, byte) for x in (docs[r.doc_id] or "").encode().split())


def test_long_words_are_not_inserted():
    scores, byte = tokens.pieces(PATH)
    trie = tokens.Trie(scores, byte)
    for word in ("x" * 1500, "hello" * 900, "中文é" * 700, "ab " .replace(" ", "\u00a0") * 800):
        assert trie.count(tokens.MARK + word) == brute(tokens.MARK + word, scores, byte)
    assert len(trie.score) == 1 and not trie.counts


def test_memory_of_a_very_long_word():
    import tracemalloc

    trie = tokens.Trie({"a": -1.0, "ab": -1.5}, -5.0)
    word = "ab" * 200_000
    tracemalloc.start()
    assert trie.count(word) == 200_000
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    tracemalloc.stop()
