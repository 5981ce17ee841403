"""The operators against brute-force versions, and on rows that every one must bear."""

import html
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import AWKWARD, awkward, awkward_rows, by_id
from tidemark.llm.chunk_dedup import dedup_substrings, gear_hash
from tidemark.llm.components import components
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import jaccard_components, one_of_each
from tidemark.llm.language_id import identify_languages
from tidemark.llm.line_crf import Chains, LineCrf, fit_crf, quality_rules
from tidemark.llm.quality_knn import quality_scores
from tidemark.llm.queries import QUERIES, VOCABULARY, id_digest
from tidemark.llm.source_mix import mix_sources
from tidemark.llm.tag_paths import main_text
from tidemark.llm.token_counts import WORD_START, PieceCounter, load_pieces, token_counts
from tidemark.llm.url_trust import judge_urls, rule_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def rough(spark):
    return awkward(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], AWKWARD)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1), (4, 0), (8, 1), (9, None), (None, 1), (3, 1), (77, 0)], "doc_id long, quality int")


# Token counts


def pieces_of(word, vocabulary):
    text, n = WORD_START + word, 0
    while text:
        length = next((k for k in range(len(text), 0, -1) if text[:k] in vocabulary), 0)
        n, text = n + (1 if length else len(text[0].encode())), text[length or 1 :]
    return n


def test_pieces_are_greedy():
    rng = random.Random(1)
    vocabulary = {"".join(rng.choice("ab" + WORD_START) for _ in range(rng.randint(1, 5))) for _ in range(25)}
    counter = PieceCounter(sorted(vocabulary))
    for _ in range(2000):
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(1, 12)))
        assert counter.count(word) == pieces_of(word, vocabulary)


def test_token_counts(spark, sf_dir, rough, nothing):
    pieces = load_pieces(VOCABULARY)
    found = by_id(QUERIES["op1_token_counts"](spark, sf_dir), "doc_id", "n_words", "n_tokens")
    memo = {}
    for row in table(sf_dir, "documents")[:60]:
        words = WORD.findall(row["text"] or "")
        tokens = sum(memo.setdefault(w, pieces_of(w, set(pieces)) if w not in memo else 0) for w in words)
        assert found[row["doc_id"]] == (len(words), tokens)
    counted = token_counts(rough, pieces, keep=rough.columns)
    assert sorted(r.n_words for r in counted.collect()) == sorted(len(WORD.findall(r[1] or "")) for r in awkward_rows())
    assert token_counts(nothing, pieces, keep=["doc_id"]).collect() == []


# Mixing


def test_mix_reaches_targets(spark, sf_dir):
    rows = QUERIES["op2_source_mix"](spark, sf_dir).collect()
    sources = {r["doc_id"]: r["source"] for r in table(sf_dir, "documents")}
    assert sum(r.target / 1 for r in {sources[r.doc_id]: r for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    for source in set(sources.values()):
        own = [r for r in rows if sources[r.doc_id] == source]
        assert own[0].target <= 2 * own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in own)


def test_mix_bears_rough_rows(rough, nothing):
    first, again = ([tuple(r) for r in mix_sources(df).collect()] for df in (rough, rough.repartition(3)))
    assert len(first) == len(awkward_rows()) and sorted(map(repr, first)) == sorted(map(repr, again))
    assert mix_sources(nothing).collect() == []


# Quality


def test_quality_on_held_out_rows(spark, sf_dir):
    found = by_id(QUERIES["op3_quality_knn"](spark, sf_dir), "doc_id", "held_out", "predicted")
    known = [(found[r["doc_id"]][1], r["quality"]) for r in table(sf_dir, "labels") if found[r["doc_id"]][0]]
    assert len(known) > 10 and np.mean([a == b for a, b in known]) > 0.9


def test_quality_bears_rough_rows(rough, nothing, labels):
    rows = quality_scores(rough, labels, F.lit(True)).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in rows if not r["doc"].text)
    assert {r["score"] for r in quality_scores(rough, labels, F.lit(False)).collect()} == {0.0}
    assert quality_scores(nothing, labels, F.lit(True)).collect() == []


# Jaccard join


def brute_components(texts, words, num, den):
    sets = []
    for text in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * (len(sets[i]) + len(sets[j]) - common) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return sets, group


@pytest.mark.parametrize(("words", "num", "seed"), [(1, 90, 0), (2, 80, 1), (3, 60, 2)])
def test_components_match_brute_force(spark, words, num, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 30)) for _ in range(rng.choice([8, 12, 40, 90]))] for _ in range(6)]
    texts = [None, "", "a"]
    for _ in range(90):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice("xyz") + str(rng.randint(0, 99))
        texts.append(" ".join(text[: rng.choice([len(text), len(text) - 1, len(text) - 3])]))
    sets, group = brute_components(texts, words, num, 100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(jaccard_components(docs, words=words, num=num, den=100), "id", "n", "component")
    assert found == {i: (len(sets[i]), group[i]) for i in range(len(texts))}


def test_jaccard_bears_rough_rows(rough, nothing):
    rows = jaccard_components(rough, words=5, num=80, den=100).collect()
    assert len(rows) == len(awkward_rows())
    assert {r.component for r in rows if r.id in (11, 12)} == {11}
    kept = Counter((r.doc_id, r.text) for r in one_of_each(rough).collect())
    assert kept[(3, "word")] == 1 and kept[(3, "other text of the id")] == 1 and kept[(11, "same text here again")] == 1
    assert (12, "same text here again") not in kept and (None, "word") not in kept and kept[(0, None)] == kept[(None, None)] == 1
    assert jaccard_components(nothing).collect() == [] and one_of_each(nothing).columns == nothing.columns


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = by_id(components(spark.createDataFrame(links, "a long, b long")), "node", "root")
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((90, 95, 100), 90)}


# Substring dedup


def test_gear_hash_depends_on_the_last_bytes():
    rng = np.random.default_rng(1)
    tail = rng.integers(0, 255, 16).astype(np.uint8)
    values = {int(gear_hash(np.concatenate([rng.integers(0, 255, n).astype(np.uint8), tail]))[-1] & 0xFFFF) for n in (0, 5, 90)}
    assert len(values) == 1


def test_passages_stay_in_one_document(spark):
    rng = random.Random(3)
    fresh = lambda n: [rng.choice("bcdfg") + rng.choice("aeiou") + str(rng.randint(0, 9999)) for _ in range(n)]
    passage = fresh(60)
    docs = [fresh(rng.randint(20, 200)) for _ in range(30)]
    texts = [" ".join(d[:5] + passage + d[5:]) if i % 3 == 0 else " ".join(d) for i, d in enumerate(docs)]
    rows = dedup_substrings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), keep=["doc_id"]).collect()
    for r in rows:
        i = r["doc"].doc_id
        if i % 3 or i == 0:
            assert r["text"] == texts[i] and r["n_removed"] == 0 and r["spans"] == [] and r["first_ids"] == []
        else:
            assert 0 in r["first_ids"] and max(r["first_ids"]) < i and r["n_removed"] >= 30
            assert set(r["text"].split()) >= set(docs[i]) and len(r["text"].split()) == r["n_words"] - r["n_removed"]
            data = texts[i].encode()
            assert all(data[s.start : s.stop].decode() in texts[i - 3] + " " for s in r["spans"])


def without_passages(spark, texts):
    rows = dedup_substrings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), keep=["doc_id"]).collect()
    return {r["doc"].doc_id: r for r in rows}


def brute_passages(texts, n=50):
    """Per text which words lie in ``n`` words that occur before, and not only overlapping themselves."""
    first, gone = {}, []
    for i, text in enumerate(texts):
        words = text.split()
        gone.append([False] * len(words))
        for k in range(len(words) - n + 1):
            j, at = first.setdefault(tuple(words[k : k + n]), (i, k))
            if j < i or k >= at + n:
                gone[i][k : k + n] = [True] * n
    return gone


def check_passages(spark, texts):
    rows, gone = without_passages(spark, texts), brute_passages(texts)
    for i, text in enumerate(texts):
        assert rows[i]["text"].split() == [w for w, out in zip(text.split(), gone[i], strict=True) if not out]
        assert rows[i]["n_removed"] == sum(gone[i]) and (rows[i]["text"] == text or any(gone[i]))
    return gone


def test_common_phrases_in_fresh_order_stay(spark):
    rng = random.Random(5)
    phrases = [" ".join(rng.choice(("in", "und", "of the", "we saw", "it", "a long day", "house", "as well as")) + f" x{rng.randint(0, 30)}" for _ in range(rng.randint(1, 4))) for _ in range(60)]
    texts = [" ".join(rng.choice(phrases) for _ in range(80)) for _ in range(400)]
    assert not any(map(any, check_passages(spark, texts)))


def test_passages_match_brute_force(spark):
    rng = random.Random(6)
    pool = [f"{rng.choice('abcdefgh') * rng.randint(1, 9)}{rng.randint(0, 50)}" for _ in range(3000)]
    source = [rng.choice(pool) for _ in range(2000)]
    texts = []
    for _ in range(150):  # pieces of one source, of all lengths, that overlap from text to text, and some fresh words
        pieces = [(k := rng.randrange(1900), source[k : k + rng.randint(20, 99)])[1] for _ in range(rng.randint(1, 6))]
        texts.append(" ".join(w for piece in pieces for w in [*piece, rng.choice(pool)]))
    texts += ["a b " * 90, "a " * 49, "a " * 300, " ".join(source[:70] * 3), "b a " * 30, " ".join("x" * 51), "y " + " ".join("x" * 51)]
    gone = check_passages(spark, [t.strip() for t in texts])
    assert sum(map(sum, gone)) > 5000


def test_every_passage_of_fifty_one_words_is_found(spark):
    rng = random.Random(7)
    fresh = lambda n: [rng.choice(("it", "a", "of", "in")) if rng.random() < 0.4 else f"{rng.choice('bcdfg') * rng.randint(1, 8)}{rng.randint(0, 9999)}" for _ in range(n)]
    passages = [fresh(51) for _ in range(3000)]
    texts = [" ".join(fresh(20) + p + fresh(20)) for p in passages] + [" ".join([f"l{i}"] + p + [f"r{i}"]) for i, p in enumerate(passages)]
    rows = without_passages(spark, texts)
    assert all(rows[i]["n_removed"] == 0 and rows[3000 + i]["text"] == f"l{i} r{i}" for i in range(3000))


def test_whole_copies_and_copies_inside_one_text(spark):
    rng = random.Random(8)
    fresh = lambda n: [rng.choice("bcdfg") + str(rng.randint(0, 99999)) for _ in range(n)]
    a, b, c = fresh(70), fresh(120), fresh(9)
    texts = [a, fresh(40), a, b + fresh(20) + a, a + b, b, a + a + a, c * 20, c * 20, fresh(30) + c * 20, b + fresh(15) + b, a, b + fresh(15) + b[:60]]
    gone = check_passages(spark, [" ".join(t) for t in texts])
    assert not any(gone[0] + gone[1] + gone[3][:120]) and all(gone[2] + gone[5] + gone[8])


def test_equal_digests_modulo_a_power_of_two_remove_and_link_nothing(spark):
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, other = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    rng = random.Random(9)
    tail = [f"w{rng.randint(0, 9999)}" for _ in range(60)]
    texts = [" ".join([*tail[:30], one, *tail[30:]]), " ".join([*tail[:30], other, *tail[30:]])]
    assert not any(map(any, check_passages(spark, texts)))
    docs = spark.createDataFrame([(0, f"{one} x y"), (1, f"{other} x y")], "doc_id long, text string")
    assert {(r["id"], r["component"]) for r in jaccard_components(docs, words=3).collect()} == {(0, 0), (1, 1)}


def test_dedup_bears_rough_rows(rough, nothing):
    rows = dedup_substrings(rough, keep=rough.columns).collect()
    assert Counter(r["doc"].text for r in rows) == Counter(r[1] for r in awkward_rows())
    assert all(r["text"] == r["doc"].text for r in rows if not r["n_removed"])
    assert dedup_substrings(nothing, keep=["doc_id"]).collect() == []


# Decontamination


def test_decontaminate_bears_rough_rows(spark, rough, nothing):
    items = spark.createDataFrame([(1, "here again"), (None, "other text"), (2, ""), (3, None), (1, "here again")], "item_id long, text string")
    rows = decontaminate(rough, items, keep=["doc_id", "score"]).collect()
    assert len(rows) == len(awkward_rows())
    assert sorted((r["doc"].doc_id, r["n_hit"], r["items"]) for r in rows if r["n_hit"]) == [(3, 2, []), (11, 2, ["1"]), (12, 2, ["1"])]
    assert decontaminate(nothing, items, keep=["doc_id"]).collect() == []
    assert {r["n_hit"] for r in decontaminate(rough, items.limit(0), keep=["doc_id"]).collect()} == {0}


# Quality rules


def base_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_base_counts(spark, sf_dir, rough, nothing, labels):
    names = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    found = by_id(QUERIES["op8_line_crf"](spark, sf_dir), "doc_id", *names, "base_failed", "kept")
    for row in table(sf_dir, "documents"):
        *counts, failed, kept = found[row["doc_id"]]
        assert tuple(counts) == base_counts(row["text"])
        assert failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0]) and not (failed and kept)
    known = [(found[r["doc_id"]][-1], r["quality"]) for r in table(sf_dir, "labels") if not found[r["doc_id"]][-2]]
    assert np.mean([a == b for a, b in known]) > 0.9
    rows = quality_rules(rough, labels, keep=["doc_id"]).collect()
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(base_counts(r[1]) for r in awkward_rows())
    assert quality_rules(nothing, labels, keep=["doc_id"]).collect() == []
    assert not any(r["kept"] and r["base_failed"] for r in quality_rules(rough, labels.limit(0), keep=["doc_id"]).collect())


def test_viterbi_and_gradient():
    rng = np.random.default_rng(2)
    rows = np.repeat(np.arange(6), [1, 4, 2, 6, 1, 3])
    features = rng.normal(size=(len(rows), 3))
    model = LineCrf(rng.normal(size=3), rng.normal(size=(2, 2)))

    def score(labels, at):
        own = labels * (features[at] @ model.weights)
        return own.sum() + sum(model.transitions[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True))

    decoded, truth, total = model.decode(features, rows), rng.integers(0, 2, len(rows)), 0.0
    for r in range(6):
        at = np.flatnonzero(rows == r)
        options = [np.array([(k >> i) & 1 for i in range(len(at))]) for k in range(1 << len(at))]
        assert score(decoded[at].astype(int), at) == pytest.approx(max(score(o, at) for o in options))
        total += score(truth[at], at) - np.logaddexp.reduce([score(o, at) for o in options])
    by_weight, by_transition = model.gradient(features, rows, truth)
    step = 1e-6
    for i in range(3):
        moved = LineCrf(model.weights + step * np.eye(3)[i], model.transitions)
        after = sum(
            (lambda at: sum(truth[at] * (features[at] @ moved.weights)) + sum(moved.transitions[truth[a], truth[a + 1]] for a in at[:-1])
             - np.logaddexp.reduce([sum(o * (features[at] @ moved.weights)) + sum(moved.transitions[o[i], o[i + 1]] for i in range(len(o) - 1))
                                    for o in ([(k >> i) & 1 for i in range(len(at))] for k in range(1 << len(at)))]))(np.flatnonzero(rows == r))
            for r in range(6)
        )
        assert by_weight[i] == pytest.approx((after - total) / step, abs=1e-3)
    assert by_transition.sum() == pytest.approx(0, abs=1e-9)
    fitted = fit_crf(features, rows, (features[:, 0] > 0).astype(np.int64))
    assert fitted.weights[0] > abs(fitted.weights[1:]).max() and len(Chains.of(rows).first) == 6


# Main text


def test_main_text_of_the_sample(spark, sf_dir):
    found = by_id(QUERIES["op9_tag_path"](spark, sf_dir), "page_id", "text", "n_chars")
    for row in table(sf_dir, "pages"):
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1].replace("<br>", " ")
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>", article))
        expected = "\n".join(p for p in parts if p)
        assert found[row["page_id"]] == (expected, len(expected))


PROSE = [f"This is sentence number {i}, which belongs to the story; it goes on for a while, as stories do." for i in range(6)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in PROSE)
AROUND = (
    '<html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p{}</style></head><body><header><h1>Site</h1></header>'
    '<nav><ul><li><a href=/a>Alpha</a><li><a href=/b>Beta</a></ul></nav><div class="cookie-notice">We use cookies, all of them; accept, please.</div>',
    '<div id="comments"><h2>Comments</h2><p>First comment, a long one, with many words, and commas, too.</p></div><aside><p>Read this as well.</p></aside>'
    '<form><p>Sign up</p><input><textarea>no</textarea></form><div class="sidebar"><p>More of it, here.</p></div><footer>&copy; Site</footer></body></html>',
)


@pytest.mark.parametrize("around", ["<article><h1>Title</h1>{}</article>", "<main><div class=content><h1>Title</h1>{}</div></main>", "<div><div class=post><h1>Title</h1>{}</div></div>", "<table><tr><td><h1>Title</h1>{}</td></tr></table>", "<article><header><h1>Title</h1></header>{}</article>"])
def test_main_text_of_layouts(around):
    assert main_text(AROUND[0] + around.format(PARAGRAPHS) + AROUND[1]) == "\n".join(["Title", *PROSE])


@pytest.mark.parametrize("around", ["<article><h1>Title</h1><div>{}</div></article>", "<main><h1>Title</h1><article>{}</article></main>", "<div><h1>Title</h1><div class=body>{}</div></div>", "<h1>Title</h1><div>{}</div>", "<div><h1>Title</h1><div class=body><h2>Title</h2>{}</div></div>"])
def test_main_text_keeps_a_title_beside_the_body(around):
    titles = ["Title"] * around.count("Title")
    assert main_text(AROUND[0] + around.format(PARAGRAPHS) + AROUND[1]) == "\n".join([*titles, *PROSE])


@pytest.mark.parametrize("around", ["<article><section>{}</section><section class=end><h2>{}</h2><p>{}</p></section></article>", "<div><div>{}</div><div class=end><h2>{}</h2><p>{}</p></div></div>", "<div>{}</div><div class=end><h2>{}</h2><p>{}</p></div>"])
def test_main_text_keeps_a_short_section(around):
    end = ("An end", "It all ends here, after all that was said.")
    assert main_text(AROUND[0] + around.format(PARAGRAPHS, *end) + AROUND[1]) == "\n".join([*PROSE, *end])


@pytest.mark.parametrize("around", ["<article><p>{}</p><div>{}</div></article>", "<div><p class=lead>{}</p><div>{}</div></div>", "<p class=lead>{}</p><div>{}</div>"])
def test_main_text_keeps_a_lead(around):
    lead = "This is what it is about, in short."
    assert main_text(AROUND[0] + around.format(lead, PARAGRAPHS) + AROUND[1]) == "\n".join([lead, *PROSE])


@pytest.mark.parametrize("around", ["<article>{}<ul>{}</ul>{}</article>", "<main><div>{}<h2>Sources</h2><ol>{}</ol>{}</div></main>", "<div class=text>{}<ul>{}</ul>{}</div>"])
def test_main_text_keeps_a_list_of_links(around):
    links = "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(4)) + "<li class=share><a href=/s>Share</a></li>"
    html = AROUND[0] + around.format(PARAGRAPHS, links, PARAGRAPHS) + AROUND[1]
    heading = ["Sources"] * ("Sources" in around)
    assert main_text(html) == "\n".join([*PROSE, *heading, *(f"Source {i}" for i in range(4)), *PROSE])


def test_main_text_of_odd_pages():
    assert [main_text(x) for x in (None, "", "<p>", "<nav><a href=/>x</a></nav>", "<script>if (a < b) {}")] == [""] * 5
    assert main_text("<article><p>One &amp; two,&nbsp;three.\n\t four<br>five<p>six <b>seven</article>") == "One & two, three. four five\nsix seven"
    assert main_text("plain text, no tags at all.") == "plain text, no tags at all."
    long = "word, " * 50_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


# Languages


def test_languages_on_held_out_rows(spark, sf_dir):
    found = by_id(QUERIES["op10_language_id"](spark, sf_dir), "doc_id", "held_out", "lang_pred", "score")
    known = [(found[r["doc_id"]][1], r["lang"]) for r in table(sf_dir, "documents") if r["lang"] and found[r["doc_id"]][0]]
    assert np.mean([a == b for a, b in known]) > 0.9
    assert all(0 <= score <= 1 for _, _, score in found.values())


def test_languages_bear_rough_rows(rough, nothing):
    rows = identify_languages(rough, id_digest(3) != 1, keep=["doc_id", "text"]).collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        lettered = any(c.isalpha() for c in r["doc"].text or "")
        assert (r["lang_pred"] == "und") == (not lettered) and (lettered or r["score"] == 0)
    assert {r["lang_pred"] for r in identify_languages(rough, F.lit(False), keep=["doc_id"]).collect()} == {"und"}
    assert identify_languages(nothing, F.lit(True), keep=["doc_id"]).collect() == []


# Url filters


def test_urls_bear_rough_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "v"), (None, "http://a.b/c", "", None), (2, "x" * 100_000, None, None), (2, "http://a.b/c", "<a href='//" + "y" * 100_000 + "'>", None)], "page_id long, url string, html string, verdict string")
    rows = judge_urls(pages, rule_table(spark, [("block", "b/"), ("allow", "b/")]), keep=pages.columns).collect()
    assert sorted((r["host"], r["path"], r["rule"], r["verdict"]) for r in rows if r["host"]) == [("a.b", "/c", "b/", "allow")] * 2
    assert {(r["path"], r["rule"], r["verdict"]) for r in rows if not r["host"]} == {("", None, "allow")}
    assert judge_urls(pages.limit(0), rule_table(spark, [("allow", "b/")]), keep=["page_id"]).collect() == []
