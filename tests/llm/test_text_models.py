import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postwave.llm import html_extract, language_id, lm, packing, rule_ensemble
from postwave.llm.tokens import WordTokens
from tests.llm.conftest import SF, remainder, row, sentence

public = pytest.importorskip("public_tokenizers")


def plain_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.public_vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_words_give_the_ids_of_the_whole_text(monkeypatch):
    r = random.Random(1)
    letters = "abzAZéÉßñçœŒÿşİıĳŉſǅΣσς漢字あ한   \t\n.,'’!?%&|<>_-019²½#$*\U0001F600ﬁİK\xa0"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 30))) for _ in range(3000)]
    texts += ["it's they're we've I'll he'd O'S", "<|endoftext|> a<|startoftext|>b", "", "\n", "a<|endoftext|>b",
              "<|endoftext|><|endoftext|>,", "x<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|"]
    words = WordTokens(packing.public_vocabulary())
    ids, n = words.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == plain_ids(texts)
    # forgetting all words changes nothing
    from postwave.llm import tokens
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    again = np.concatenate([words.encode([t.encode()])[0] for t in texts])
    assert (again == ids).all()


def test_letters_of_a_word_are_merged_once_for_all_spellings():
    words = WordTokens(packing.public_vocabulary())
    asked, merges = [], words.merges

    class Counted:
        def tokenize(self, letters):
            asked.append(letters)
            return merges.tokenize(letters)
    words.merges = Counted()
    texts = ["Ontionoror ontionoror, ONTIONOROR. (Ontionoror", "ontionoror###", "\u00c9toile! \u00e9toile"]
    ids, n = words.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == plain_ids(texts)
    assert sorted(asked, key=len)[-2:] == ["\u00c3\u00a9toile", "ontionoror"] and len(set(asked)) == len(asked)


def test_letters_stay_as_they_are_before_marks_and_in_special_tokens():
    """NFC has a letter for h with a line below but none for H with one, and
    only the special tokens' own spelling is special."""
    texts = ["H\u0331 h\u0331 T\u0308 t\u0308x A\u0301 I\u0307", "<|ENDOFTEXT|> The <|endoftext|> THE", "<|EndOfText|>",
             "<|startoftext|>The", "The THE the"]
    words = WordTokens(packing.public_vocabulary())
    for _ in range(2):
        ids, n = words.encode([t.encode() for t in texts])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == plain_ids(texts)
    assert words.encode([])[0].tolist() == []


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """A file that is not split at white space is not taken apart."""
    import json
    from tokenizers import Tokenizer
    with open(packing.public_vocabulary()) as f:
        file = json.load(f)
    assert WordTokens(packing.public_vocabulary()).by_words
    file["normalizer"] = None
    file["added_tokens"][1]["lstrip"] = True
    path = str(tmp_path / "other.json")
    with open(path, "w") as f:
        json.dump(file, f)
    words, t = WordTokens(path), Tokenizer.from_file(path)
    texts = ["Hello  World <|endoftext|>x", "", "é A\nb", sentence(1, 300)]
    ids, n = words.encode([x.encode() for x in texts])
    assert not words.by_words
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def check_windows(pieces, size=4096):
    windows = defaultdict(list)
    for r in pieces:
        windows[r.sequence_id].append((r.offset, r.length))
    short = 0
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size
        short += at < size
    assert sorted(windows) == list(range(len(windows)))
    return short


def test_packing_round_trip(odd, odd_rows, none):
    found = packing.pieces(odd).collect()
    assert check_windows(found) <= 1
    want = Counter((r[0], tuple(x + [packing.END])) for r, x in zip(odd_rows, plain_ids(r[1] for r in odd_rows)))
    told = Counter(r[0] for r in odd_rows)
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    for doc_id, many in told.items():
        if many == 1:
            ids = [i for r in sorted(by[doc_id], key=lambda r: r.start) for i in r.ids]
            assert want[doc_id, tuple(ids)] == 1 and {r.doc_tokens for r in by[doc_id]} == {len(ids)}
    assert sum(r.length for r in found) == sum(len(t) * n for (_, t), n in want.items())
    assert packing.pieces(none).count() == 0
    crc = packing.digest(odd).collect()
    assert Counter((r.doc_id, r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found) == Counter(
        (r.doc_id, r.start, r.ids_crc32) for r in crc)


def test_windows_hold_the_mixture(spark, monkeypatch):
    """Every full window has each queue's share to a token, as a sequential
    deficit round-robin gives it; small sources share a queue."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    rows = [(i, sentence(i, 3 + i % 50), "hot" if i % 3 else f"s{i % 4}" if i % 90 else "tiny") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    found = packing.pieces(docs, window=512).collect()
    assert check_windows(found, 512) == 1
    total, by = sum(r.length for r in found), Counter()
    share = defaultdict(Counter)
    for r in found:
        by[source[r.doc_id]] += r.length
        share[r.sequence_id][source[r.doc_id]] += r.length
    for w in range(total // 512):
        for q in packing._queues(list(by.items()), 512):
            assert abs(sum(share[w][s] - 512 * by[s] / total for s in q)) < 2
    assert packing._queues([("a", 10 ** 6), ("b", 1), ("c", 1)], 512) == [["b", "c", "a"]]
    assert packing._queues([], 512) == []


def test_small_sources_take_turns(spark, monkeypatch):
    """A thousand sources of a few documents: the joint queue mixes them."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 50)
    rows = [(i, sentence(i, 40), "hot" if i % 2 else f"s{i % 1000:03d}") for i in range(4000)]
    found = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string, source string"), window=512).collect()
    assert check_windows(found, 512) == 1
    source = {i: s for i, _, s in rows}
    first = [source[r.doc_id] for r in found if r.sequence_id < 40 and source[r.doc_id] != "hot"]
    # sources by name would give eight documents of each in turn
    assert len(set(first)) > 0.8 * len({r.doc_id for r in found if r.sequence_id < 40 and source[r.doc_id] != "hot"})
    assert set(first) - {f"s{k:03d}" for k in range(0, 100)}


def test_windows_hold_the_targets(spark):
    rows = [(i, sentence(i, 30), ("a", "b", None)[i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source, targets = {i: s for i, _, s in rows}, {"a": 6, "b": 3, None: 1}
    found = packing.pieces(docs, window=512, targets=targets).collect()
    assert check_windows(found, 512) == 1
    whole, total = packing.pieces(docs, window=512).collect(), Counter()
    for r in whole:
        total[source[r.doc_id]] += r.length
    by, share = defaultdict(list), defaultdict(Counter)
    for r in found:
        by[r.doc_id].append((r.start, tuple(r.ids)))
        share[r.sequence_id][source[r.doc_id]] += r.length
    joined = lambda rows: {i: [x for _, ids in sorted(v) for x in ids] for i, v in rows.items()}
    plain = defaultdict(list)
    for r in whole:
        plain[r.doc_id].append((r.start, tuple(r.ids)))
    assert joined(by) == joined(plain)
    full = int(total["a"] / (0.6 * 512))
    for w in range(full):
        assert all(abs(share[w][s] - 51.2 * t) < 2 for s, t in targets.items())
    # then the others in their proportions, without the one that ran out
    for w in range(full + 1, full + 1 + int((total["b"] - 0.3 * 512 * (full + 1)) / (0.75 * 512)) - 1):
        assert abs(share[w]["b"] - 0.75 * 512) < 2 and share[w]["a"] == 0


def test_phases_use_up_every_queue():
    r = random.Random(6)
    for _ in range(200):
        totals = [r.randrange(0, 50_000) for _ in range(r.randrange(1, 9))]
        shares = [r.choice((0, r.random(), r.random())) for _ in totals]
        phases = packing.phases_of(totals, shares, 512)
        assert [sum(p[1][i] for p in phases) for i in range(len(totals))] == totals
        for (w, sizes), (after, _) in zip(phases, phases[1:]):
            assert sum(sizes) == 512 * (after - w)
        assert len(phases) <= 3 * len(totals) + 3


def test_places_of_very_large_queues():
    upto = [0, 3 * 10 ** 14 + 1, 10 ** 15 + 7]
    for s, at, n in ((0, 10 ** 14, 9000), (1, upto[2] - upto[1] - 5000, 5000), (0, 0, 1)):
        cuts = packing._cuts(upto, s, at, n, 4096)
        assert sum(c[1] for c in cuts) == n and [c[0] for c in cuts] == list(np.cumsum([0] + [c[1] for c in cuts])[:-1])
        assert all(0 <= c[3] and c[3] + c[1] <= 4096 for c in cuts)


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def want_lm(rows):
    uni, pairs = Counter(), Counter()
    for r in rows:
        if remainder(r[0], 5) != 1:
            t = tokens(r[1])
            uni.update(t)
            pairs.update(zip([None] + t[:-1], t))
    context, kinds, cont = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (v, w), c in pairs.items():
        context[v] += c
        kinds[v][min(c, 3) - 1] += 1
        cont[w] += 1
    of = lambda x: lm.discounts(*(Counter(x.values())[k] for k in (1, 2, 3, 4)))
    d2, d1, n, v = of(pairs), of(cont), sum(uni.values()), len(uni)
    even = sum(d1[min(c, 3)] for c in cont.values()) / len(pairs) / (v + 1)

    def p(u, w):
        low = max(cont[w] - d1[min(cont[w], 3)], 0) / len(pairs) + even
        if not context[u]:
            return low
        c = pairs[u, w]
        return (max(c - d2[min(c, 3)], 0) + sum(d * k for d, k in zip(d2[1:], kinds[u])) * low) / context[u]

    out = Counter()
    for r in rows:
        t = tokens(r[1])
        out[r[0], len(t), sum(uni[w] > 0 for w in t), n,
            round(sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6),
            round(sum(math.log10(p(u, w)) for u, w in zip([None] + t[:-1], t)), 6)] += 1
    for u in [None, next(iter(uni))]:
        assert abs(sum(p(u, w) for w in uni) + p(u, b"\0unknown") - 1) < 1e-9
    return out


def test_lm(odd, odd_rows, none):
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in lm.evaluate(odd).collect())
    assert got == want_lm(odd_rows)
    assert lm.evaluate(none).count() == 0


def test_lm_with_split_contexts(spark):
    """A context in every other place is dealt over the shards."""
    rows = [row(i, " the ".join(sentence(i, 30).split())) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert len(lm._hot_contexts(docs)) >= 1
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in lm.evaluate(docs).collect())
    assert got == want_lm(rows)


def test_lm_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = lm.train(docs.limit(0))
    r = lm.score(docs, model, "doc_id").first()
    assert (r.n_tokens, r.n_known, r.base_score, r.score) == (3, 0, 0, 0)


def phrases(text, sample):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_are_the_longest_matches():
    r = random.Random(3)
    samples = {k: "".join(r.choice(a) for _ in range(300)) for k, a in (("x", "abc"), ("y", "bcd"), ("z", "ab"))}
    known = language_id.Languages(samples)
    texts = ["".join(r.choice("abcde") for _ in range(r.randrange(0, 200))) for _ in range(60)]
    found, letters = known.phrases([t.encode() for t in texts])
    assert letters.tolist() == [len(t) for t in texts]
    for k, name in enumerate(known.names):
        assert found[k].tolist() == [phrases(t, samples[name]) for t in texts]


def test_languages(spark, odd, odd_rows, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language_id.identify(docs).collect() if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.97 * len(held)
    got = language_id.identify(odd).collect()
    assert len(got) == len(odd_rows)
    letters = {r[0]: bool(re.search(r"[^\W\d_]", r[1] or "")) for r in odd_rows if r[0] not in (None, 12)}
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0)
        if r.doc_id in letters:
            assert (r.lang_pred == "und") == (not letters[r.doc_id])
    assert language_id.identify(none).count() == 0
    # nothing labelled
    assert {r.lang_pred for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_small_samples_are_not_cheap(spark):
    """A label of digits only is never predicted; a rare language is, for its
    own texts alone."""
    r = random.Random(9)
    stems = {k: ["".join(r.choice(a) for _ in range(r.randrange(2, 8))) for _ in range(150)]
             for k, a in (("x", "abcdefgh"), ("y", "efghijkl"), ("rare", "bdfhjlmn"))}
    lang = lambda i: "x" if i < 60 else "y" if i < 120 else "rare"
    rows = [(i, " ".join(r.choice(stems[lang(i)]) for _ in range(80)), lang(i) if i < 122 else None) for i in range(150)]
    rows += [(200 + i, "12 345 6789", "und") for i in range(5)]
    # two labelled texts that are learned from, whatever their id
    rows = [(i + 1000 if t in (120, 121) and remainder(i, 5) == 0 else i, x, t2) for t, (i, x, t2) in enumerate(rows)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    for g in got:
        i = g.doc_id % 1000
        assert g.lang_pred == ("und" if i >= 200 else lang(i)), g
    few = language_id.identify(spark.createDataFrame(
        [(i, "abc", "few") if i == 1 else (i, rows[i][1], "x") for i in range(40)],
        "doc_id long, text string, lang string"))
    # the label of a three-letter text is learned, and wins no other text
    assert {g.lang_pred for g in few.collect() if g.doc_id != 1} == {"x"}


def test_choice_by_brute_force():
    """Bits, language and score from phrases counted one by one."""
    r = random.Random(12)
    samples = {"x": "abcab" * 90, "y": "".join(r.choice("bcd") for _ in range(900)), "z": "ab"}
    known = language_id.Languages(samples)
    texts = ["".join(r.choice(a) for _ in range(r.randrange(1, 150))) for a in ("abc", "bcd", "ab", "abe", "eee")
             for _ in range(12)] + ["", "12 3"]
    names, score = known.predict([t.encode() for t in texts])
    size = {k: max(len(v), 200) for k, v in samples.items()}
    most = math.log2(max(size.values()))
    for text, name, s in zip(texts, names, score):
        if not any(c.isalpha() for c in text):
            assert (name, s) == ("und", 0.0)
            continue
        bits = {}
        for k, sample in samples.items():
            absent = sum(c not in sample for c in text)
            bits[k] = ((phrases(text, sample) - absent) * math.log2(size[k]) + absent * (most + math.log2(known.letters))
                       + most - math.log2(size[k]))
        low = sorted(bits.values())
        assert name == min(bits, key=lambda k: (round(bits[k], 9), k))
        assert abs(s - low[1] / (low[0] + low[1])) < 1e-9


def test_every_language_is_learned_whole(spark):
    """Short, long and few texts; many languages share one bound."""
    rows = [(i, "x" * 30 + str(i), "short") for i in range(40)] + [(100, "ab" * 90_000, "long"), (101, "c", "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = dict(language_id.learn(docs))
    assert sorted(got) == ["long", "one", "short"] and got["one"] == "c"
    assert sorted(got["short"].split("\n")) == sorted(t for _, t, k in rows if k == "short")
    assert len(got["long"]) == language_id.LANGUAGE_LETTERS // language_id.ROW_PART
    many = spark.createDataFrame([(i, f"text {chr(97 + i % 26)}" * 50, f"l{i % 300:03d}") for i in range(900)],
                                 "doc_id long, text string, lang string")
    got = dict(language_id.learn(many, sample_letters=120_000))
    assert len(got) == 300 and all(0 < len(t) <= 400 + 20 for t in got.values())


def test_large_alphabets():
    """No letter of a sample is left out, however many there are."""
    r = random.Random(4)
    samples = {k: "".join(chr(0x4E00 + r.randrange(a, a + 900)) for _ in range(2000)) for k, a in (("x", 0), ("y", 600))}
    known = language_id.Languages(samples)
    texts = ["".join(chr(0x4E00 + r.randrange(1600)) for _ in range(50)) for _ in range(20)] + [samples["y"][300:400]]
    found, _ = known.phrases([t.encode() for t in texts])
    for k, name in enumerate(known.names):
        assert found[k].tolist() == [phrases(t, samples[name]) for t in texts]
    single = known.parse([t.encode() for t in texts])[1]
    for k, name in enumerate(known.names):
        assert single[k].tolist() == [sum(c not in samples[name] for c in t) for t in texts]


def test_samples_come_from_whole_texts(spark):
    """A header that all texts have is not all that is learned."""
    rows = [(i, "header " * 200 + sentence(i, 300).replace("w", "body"), "x") for i in range(50)]
    (_, sample), = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "body" in sample and "header" in sample


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a></li></ul></nav><!-- no --><div class="ad">Buy</div><div class="cookie-notice">OK?</div>
<article><header>By me</header><h1>A &amp; B</h1><p><b>one\n  two<br>three<p>f&uuml;r &lt;b&gt; &#x41;&nbsp;z</p>
<aside>side</aside><form>mail<input></form><div class="comments"><p>first!</p></div><p>x < y</p></article>
<footer>&copy; host</footer></body></html>"""


def test_article_of_a_page(spark, none):
    rows = [(1, "http://h.org/a", PAGE), (1, "http://h.org/a", PAGE), (2, None, None), (3, "http://h.org/b", ""),
            (4, "x", "<p>no article <b>here</b><nav>never closed <p>still text"), (None, "http://H.org/c", PAGE)]
    pages = spark.createDataFrame([(*r, 1, "c") for r in rows], "page_id long, url string, html string, page int, host string")
    got = html_extract.extract(pages).collect()
    want = "A & B\none two three\nfür <b> A z\nx < y"
    assert Counter((r.page_id, r.text) for r in got) == Counter(
        [(1, want)] * 2 + [(2, ""), (3, ""), (4, "no article here\nnever closed\nstill text"), (None, want)])
    assert all(r.n_chars == len(r.text) for r in got)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(empty).count() == 0


def test_repeats_of_a_host(spark):
    """Without articles, blocks that other pages of the host have go."""
    menu, foot = "home news sport weather travel food contact", "all rights reserved by this paper since long ago"
    rows = [(i, f"http://{'a' if i % 4 else 'b'}.org/{i}",
             f"<div>{menu}</div><div>{sentence(i, 30)}</div><p>short {i}</p><div>{foot} {i}</div>") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_extract.extract(pages).collect():
        assert r.text == f"{sentence(r.page_id, 30)}\nshort {r.page_id}"
    alone = html_extract.extract(pages.limit(1)).first()
    assert alone.text.count("\n") == 3


def texts_of(html):
    return html_extract.main_blocks(html_extract.blocks(html), ())


def test_odd_markup():
    of = texts_of
    # letters whose lower case is longer do not shift what follows
    assert of("İ" * 10 + "<script>x<article></SCRIPT><article><p>text</article>") == ["İ" * 10, "text"]
    assert of('<p title="a > b" class=\'<x>\'>one<p class=y">two<a href="u>v">three</a>') == ["one", "twothree"]
    assert of("a < b <3 <!x <p>c<!-- <p> --><![CDATA[z]]><!DOCTYPE q>d") == ["a < b <3 cd"] or of("a < b") == ["a < b"]
    assert of('<div class="article-header"><h1 id="share">Title</h1></div><header>no</header>') == ["Title"]
    assert of('<div class="site-header">no</div><div class="post">yes</div>') == ["yes"]
    assert of("<title>t<p>never closed") == []
    # a teaser in an article is not all of the page
    assert of("<article>teaser</article><div><p>a long story</p></div>") == ["teaser", "a long story"]


@pytest.mark.parametrize("piece", ["<div class=ad>", "<nav ", '<nav x="', "<a x='b' ", "<!x ", "<article>", "<script ",
                                   "</nav", "<p title=\"<", "<", "<nav><x "])
def test_unclosed_markup_takes_linear_time(piece):
    import time
    page = (piece * (1_000_000 // len(piece)))
    start = time.process_time()
    html_extract.blocks(page)
    first = time.process_time() - start
    assert first < 5
    start = time.process_time()
    html_extract.blocks(page[:len(page) // 4])
    assert first < 12 * (time.process_time() - start) + 0.3


def test_suffix_names_by_brute_force():
    r = random.Random(3)
    for depth in (1, 2, 3, 5, 6, 8, 13):
        pages = [[r.randrange(4) for _ in range(r.randrange(20))] for _ in range(60)]
        h = html_extract.mix(np.array([w + 1 for p in pages for w in p], np.uint64))
        page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        name, owner = html_extract.names(h, page, depth)
        want = [(i, tuple(p[k:k + depth])) for i, p in enumerate(pages) if p
                for k in range(max(1, len(p) - depth + 1))]
        assert owner.tolist() == [i for i, _ in want]
        by = defaultdict(set)
        for x, (_, w) in zip(name.tolist(), want):
            by[w].add(x)
        assert all(len(x) == 1 for x in by.values()) and len(set(name.tolist())) == len(by)


def test_copies_of_an_article_are_no_boilerplate(spark):
    """The same article at two addresses, without ``article`` elements."""
    menu = "home news sport weather travel food contact"
    page = lambda k, extra="": f"<div>{menu}</div><div>{sentence(k, 60)}</div><p>by nobody{extra}</p>"
    rows = [(1, "http://a.org/1", page(1)), (2, "http://a.org/1?print", page(1, " (print)")), (3, "http://a.org/2", page(2)),
            (4, "http://b.org/1", page(1)), (5, "http://b.org/1?x", page(1))]
    got = {r.page_id: r.text for r in html_extract.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == f"{sentence(1, 60)}\nby nobody" and got[2] == f"{sentence(1, 60)}\nby nobody (print)"
    assert got[3] == f"{sentence(2, 60)}\nby nobody"
    assert got[4] == got[5] == f"{menu}\n{sentence(1, 60)}\nby nobody"


def test_covered_blocks_by_brute_force():
    r = random.Random(8)
    stock = [sentence(k, 9, 30) for k in range(6)]
    pages = [[(html_extract.OPEN, r.choice(stock) if r.random() < 0.5 else sentence(100 + 10 * i + j, r.randrange(1, 14), 30))
              for j in range(6)] for i in range(10)]
    words = [[w for _, t in p for w in t.split()] for p in pages]
    depth = html_extract.DEPTH
    where = defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w)):
            where[tuple(w[k:k + depth])].add(i)
    for i, (page, w) in enumerate(zip(pages, words)):
        inside = {j for k in range(len(w)) if len(where[tuple(w[k:k + depth])]) > 1 for j in range(k, min(k + depth, len(w)))}
        head = html_extract._streams([page])[0].astype(np.int64)
        marks = [h for k, h in enumerate(head.tolist()) if len(where[tuple(w[k:k + depth])]) > 1]
        at, want = 0, []
        for _, t in page:
            n = len(t.split())
            if len(inside & set(range(at, at + n))) < html_extract.COVERED * n:
                want.append(t)
            at += n
        assert html_extract.main_blocks(page, marks) == want


def test_classifier(spark, odd, odd_rows, none, labels):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in marks.collect()}
    held = [r for r in rule_ensemble.classify(docs, marks).collect() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)
    got = rule_ensemble.classify(odd, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (remainder(r.doc_id, 3) == 1)
    assert rule_ensemble.classify(none, labels).count() == 0
    assert {r.score for r in rule_ensemble.classify(odd, labels.limit(0)).collect()} == {0.5}


def test_accept_keeps_what_classify_predicts(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = rule_ensemble.accept(docs, marks)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in rule_ensemble.classify(docs, marks).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == want


def test_a_hot_text_does_not_fill_the_sample(spark):
    """Copies of one text are drawn by their ids, and each label has its rows."""
    for hot in range(4):
        rows = [(i, 0.1 * (hot + 1) if i % 4 else 1.0 + i, int(i % 4 > 0)) for i in range(800)]
        docs = spark.createDataFrame(rows, "doc_id long, x double, label int").select(
            "doc_id", *(F.col("x").alias(f) for f in rule_ensemble.FEATURES), "label")
        model = rule_ensemble.fit(docs, trees=3, train_rows=100)
        assert model.weights
    rare = docs.withColumn("label", (F.col("doc_id") >= 5).cast("int"))
    assert rule_ensemble.fit(rare, trees=3, train_rows=100).weights


def test_paths_of_trees():
    debug = """Model
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 3.0)
      Predict: 1.0
     Else (feature 0 > 3.0)
      Predict: 0.0
"""
    a, c = rule_ensemble.FEATURES[0], rule_ensemble.FEATURES[2]
    assert set(rule_ensemble.paths(debug)) == {
        ((a, "<=", 1.5),), tuple(sorted([(a, "<=", 1.5), (c, "<=", 0.25)])),
        tuple(sorted([(a, "<=", 1.5), (c, ">", 0.25)])), ((a, ">", 1.5),),
        ((a, "<=", 3.0), (a, ">", 1.5)), ((a, ">", 3.0),)}


def plain_features(text):
    """The statistics of a text, one by one."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n, chars, lines = max(len(w), 1), len(re.sub(r"[\x20\x09-\x0D]", "", t)), t.split("\n")
    of = lambda cs: sum(t.count(c) for c in cs)
    filled = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    split = w or [""]
    return {"log_words": math.log1p(len(w)), "word_length": chars / n, "symbols": of(rule_ensemble.SYMBOLS) / n,
            "marks": of("!?") / n, "stops": of(".,;:") / n, "digits": of("0123456789") / n,
            "capitals": of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / max(chars, 1), "dup_lines": (len(filled) - len(set(filled))) / len(lines),
            "variety": math.log(len(set(split))) / math.log(n + 1),
            "next_same": sum(a == b for a, b in zip(split, split[1:])) / n,
            "short_lines": sum(len(x) < 20 for x in lines) / len(lines)}


def test_features_and_score_by_brute_force(spark, odd, odd_rows):
    r = random.Random(21)
    texts = [t for _, t, *_ in odd_rows] + ["".join(r.choice("aB1 .!#\n\t\x0bé漢") for _ in range(r.randrange(80))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = []
    for _ in range(25):
        rule = [(r.choice(rule_ensemble.FEATURES), r.choice(("<=", ">")), r.choice((0.0, 0.1, 0.5, 1.0, 3.0))) for _ in range(r.randrange(1, 4))]
        rules.append((rule_ensemble._tidy(tuple(rule)), r.uniform(-2, 2)))
    model = rule_ensemble.RuleModel(rules, -0.3)
    got = rule_ensemble.with_statistics(docs, "doc_id").withColumn("score", model.score()).collect()
    assert len(got) == len(texts)
    for g in got:
        want = plain_features(texts[g.doc_id])
        for f in rule_ensemble.FEATURES:
            assert abs(g[f] - want[f]) < 1e-12, (f, texts[g.doc_id])
        total = -0.3 + sum(w for rule, w in rules if all(g[n] <= v if s == "<=" else g[n] > v for n, s, v in rule))
        assert abs(g.score - 1 / (1 + math.exp(-total))) < 1e-12


def test_folders_that_workers_cannot_reach():
    with pytest.raises(ValueError, match="viewfs"):
        lm._store("viewfs://store/x")
