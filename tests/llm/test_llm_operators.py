"""The operators against plain re-computations, and on awkward tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fundlens.llm import decontaminate, grades, html_text, jaccard, language, licences, lm, packing, quality_rules, sharding
from fundlens.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length long, start long, batch long"
SAME = "one two three four five six seven eight nine ten " * 12
ROWS = [
    (1, SAME, "en", "a", 1, 9, 9, 9),
    (2, SAME, "en", "a", 1, 9, 9, 9),
    (2, SAME, "en", "a", 1, 9, 9, 9),
    (3, SAME.replace("seven", "Seven", 1), None, None, None, None, None, None),
    (4, "", "en", "b", 0, 9, 9, 9),
    (5, None, None, "b", None, 9, 9, 9),
    (6, " \t\n ### 123 ", "en", "b", 3, 9, 9, 9),
    (None, "Released under the MIT License.", "en", "c", 3, 9, 9, 9),
    (7, "It's a <|endoftext|> of Ünïcödé, ét ÀÉ. I'LL go.Now,then ...", "fr", "c", 3, 9, 9, 9),
    (8, " ".join(f"word{i}" for i in range(6000)), "en", "c", 3, 9, 9, 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing_is_exact(docs):
    tokenizer, want = Tokenizer.from_file(TOKENIZER), Counter()
    for doc_id, text, *_ in ROWS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 64):
            piece = np.array(ids[at : at + 64], "<u4").tobytes()
            want[(doc_id, at, len(piece) // 4, zlib.crc32(piece), len(ids))] += 1
    rows = packing.pack_documents(docs, TOKENIZER, capacity=64).collect()
    assert Counter((r.doc_id, r.start, r["length"], r.ids_crc32, r.doc_tokens) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    with_ids = packing.pack_documents(docs, TOKENIZER, capacity=64, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in with_ids)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=12))
def test_placed_lengths_tile_the_sequences(histogram):
    filled, ranks = {}, {}
    for n, rank, count, first, offset in packing.place_lengths(histogram, 32):
        assert ranks.get(n, 0) == rank
        ranks[n] = rank + count
        for s in range(first, first + count):
            assert filled.get(s, 0) == offset
            filled[s] = offset + n
    assert ranks == histogram and all(v <= 32 for v in filled.values())


def test_shards_are_contiguous_and_even(spark, docs):
    rows = [(i, "x" * (i * 37 % 101)) for i in range(500)]
    placed = sorted(sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect())
    shards = [r.shard for r in placed]
    assert shards == sorted(shards) and set(shards) == set(range(7))
    sums = Counter()
    for r in placed:
        sums[r.shard] += r.size
        assert r.text_crc32 == zlib.crc32(rows[r.doc_id][1].encode())
    assert max(sums.values()) - min(sums.values()) <= 2 * 101
    for s in range(7):
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(shards.count(s)))
    assert sharding.shard_by_bytes(docs).count() == len(ROWS)


def _sets():
    out = {}
    for doc_id, text, *_ in ROWS:
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        out[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def test_components_of_awkward_rows(docs):
    sizes = {k: len(v) for k, v in _sets().items()}
    got = jaccard.similar_components(docs).collect()
    assert sorted((r.doc_id or 0) for r in got) == sorted((r[0] or 0) for r in ROWS)
    assert all(r.n_shingles == sizes[r.doc_id] for r in got)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert all(r.component_id == r.doc_id for r in got if r.doc_id not in (1, 2, 3))


def _all_pairs(rows):
    """Least id of each component, by comparing all pairs of sets."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in rows}


def test_components_equal_all_pairs(spark):
    """Chains of edits: texts that are linked only through others, and many stars per family."""
    random, rows = np.random.default_rng(5), []
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(60)]
        for _ in range(25):
            words = list(words)
            words[random.integers(60)] = f"x{random.integers(10**6)}"
            rows.append((len(rows), " ".join(words[: random.integers(52, 61)])))
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == _all_pairs(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_borderline_families_and_shared_passages(spark, seed, monkeypatch):
    """Copies of one text around the threshold, passages that many texts share, short texts, exact copies."""
    random, rows = np.random.default_rng(seed), []
    passages = [" ".join(f"p{p}w{i}" for i in range(30)) for p in range(4)]
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(int(random.integers(20, 160)))]
        for _ in range(40):
            words = [f"x{random.integers(10**6)}" if random.random() < random.choice([0.0, 0.01, 0.03]) else w for w in base]
            text = " ".join(words[int(random.integers(0, 4)) :])
            if random.random() < 0.3:
                text += " " + passages[random.integers(4)]
            rows.append((len(rows), text))
    for _ in range(40):
        picked = random.permutation(4)[: int(random.integers(1, 5))]
        rows.append((len(rows), " ".join(passages[p] for p in picked)))
        rows.append((len(rows), " ".join(["a", "b", "c", "d", "e", "f", "g"][: int(random.integers(0, 8))])))
    rows += [(len(rows) + i, rows[i][1]) for i in range(0, 100, 7)] + [(len(rows) + 50, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = _all_pairs(rows)
    assert {r.doc_id: r.component_id for r in jaccard.similar_components(frame).collect()} == want
    # However little contraction finds, opening the stars finds the rest.
    monkeypatch.setattr(jaccard, "_drawn_sets", lambda across, percent: across.select("node", "star", F.col("node").alias("other")).limit(0))
    monkeypatch.setattr(jaccard, "GROUP_SETS", 3)
    assert {r.doc_id: r.component_id for r in jaccard.similar_components(frame).collect()} == want


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(0, 20), st.integers(0, 20), st.integers(0, 2**32 - 1))
def test_prefixes_of_linked_sets_share_enough(common, left, right, seed):
    random = np.random.default_rng(seed)
    tokens = random.permutation(10_000)[: common + left + right]
    a, b = sorted(tokens[: common + left]), sorted([*tokens[:common], *tokens[common + left :]])
    if 100 * common < 80 * (common + left + right):
        return

    needs = lambda n: jaccard.prefix_needs(n, 80)
    heads = [set(s[: needs(len(s))[0]]) for s in (a, b)]
    for s in (a, b):
        assert len(heads[0] & heads[1]) >= needs(len(s))[1]


def test_decontamination_against_edit_distance(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards boxed quietly near the old mill."
    texts = ["pad " * 30 + item.upper().replace(" ", ",  ") + " more words here", "nothing of the kind " * 10, None, ""]
    texts += ["start " + item.replace("quietly", "quitly").replace("wizards", "wizard") + " end", item[:40] + " other ending " * 5]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "tiny")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.benchmark_matches(frame, bench).collect()}
    assert got == {(0, 1): 0, (4, 1): 2}
    rounds = decontaminate.benchmark_matches(frame, bench, round_bytes=40).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in rounds} == got


def _semi_global(item: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", min_size=1, max_size=20))
def test_alignment_is_least_and_consistent(item, text):
    edits, start, end = decontaminate.align(item.encode(), text.encode(), 99)
    assert edits == _semi_global(item.encode(), text.encode())
    assert 0 <= start <= end <= len(text)


def test_licences(docs, spark):
    mit = licences.KNOWN[8][1]
    changed = "Copyright (c) 2020 Somebody\n" + mit.replace("MIT License", "MIT  LICENCE").upper()
    frame = spark.createDataFrame([(1, changed), (2, "text\nReleased under the MIT licence\nend"), (3, mit + " more"), (4, None)], "doc_id long, text string")
    assert {(r.doc_id, r.line_no, r.licence) for r in licences.licence_matches(frame).collect()} == {(1, 0, "MIT"), (2, 2, "MIT")}
    assert [(r.doc_id, r.line_no) for r in licences.licence_matches(docs).collect()] == [(None, 0)]


def test_quality_rules_on_lines_and_awkward_rows(spark, docs):
    # Digits of a line count as equal, so the words here are of letters; none repeats within a text.
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    boiler = " ".join(f"offer{letters(k)}" for k in range(60))
    own = lambda i, n: " ".join(f"d{letters(i)}w{letters(k)}" for k in range(n))
    rows = [(i, f"{boiler}\n{own(i, 20 if i < 15 else 90)}", "h") for i in range(30)] + [(99, own(99, 80), "h")]
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].n_removed_words == 60 for i in range(30)) and got[99].n_removed_words == 0
    assert not any(r.base_failed for r in got.values())
    assert not any(got[i].kept for i in range(15)) and all(got[i].kept for i in [*range(15, 30), 99])
    awkward = quality_rules.quality_verdicts(docs).collect()
    assert len(awkward) == len(ROWS) and {r.n_words for r in awkward if r.doc_id in (4, 5)} == {0}
    assert all(r.n_repeat_words == 120 for r in awkward if r.doc_id in (1, 2))


def test_pages():
    tree = html_text.BlockTree.fit()
    page = """<body><nav><a href=/>Home</a> <a href=/b>News of today</a></nav><div class="cookie-banner">We use cookies on this
    site to make it better for you and all others.</div><article><header><h1>Title &amp; more</h1></header><p>Short.</p><p>A
    longer&nbsp;text with <a href=/x>a link</a> and <b>bold</b> words.<script>var a = "</p>";</script></p><aside>Read also this
    other story about something.</aside><p>Last one</article><form>Your mail <input></form><section class=comments><p>I liked
    this article very much, thanks for all of it.</p></section><footer>All rights</footer>"""
    assert html_text.main_text(page, tree) == "Title & more\nShort.\nA longer text with a link and bold words.\nLast one"
    assert [html_text.main_text(x, tree) for x in (None, "", "<p>", "<", "<div class='")][:3] == ["", "", ""]


LONG = "A plain paragraph of the article with quite a few words in it."


@pytest.mark.parametrize(
    "page, expected",
    [
        (f'<nav><a href=/>Home</a></nav><article><p class="social">{LONG}</p><p>End.</p></article>', f"{LONG}\nEnd."),
        (f'<article><h1>Title</h1><div class="side-by-side"><p>{LONG}</p></div></article><footer>Rights</footer>', f"Title\n{LONG}"),
        (f"<form><div class=menu><a href=/>a</a></div><h1>Title</h1><p>{LONG}</p><p>More of it.</p><div class=footer>{LONG}</div></form>", f"Title\n{LONG}\nMore of it."),
        (f'<article><p>{LONG}</p><p class="ad">Buy now<p>{LONG}</p><ul><li class="ad">Buy<li>Item</ul></article>', f"{LONG}\n{LONG}\nItem"),
        (f"<article><h1><a href=/>Title of it</a></h1><p>{LONG}</p><p>Short.</p></article><nav><a href=/>x</a></nav>", f"Title of it\n{LONG}\nShort."),
        (f"<main><p>{LONG}</p><p>Last</p></main><form>{LONG}<input></form><div class=comments><p>{LONG * 4}</p></div>", f"{LONG}\nLast"),
        (f"<div><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul><p>{LONG}</p></div>", LONG),
        (f"<main><p>{LONG}</p><p>Last</p></main><div class=widget><p>{LONG}</p></div>", f"{LONG}\nLast"),
        (f"<article><p>{LONG}</p></article><div class=related><ul><li><a href=/a>{LONG}</a><li><a href=/b>{LONG}</a></ul></div>", LONG),
        ("<p>One</p>", "One"),
    ],
)
def test_article_text_survives_hints_forms_and_unclosed_parts(page, expected):
    assert html_text.main_text(page, html_text.BlockTree.fit()) == expected


def test_links_stay_open_over_blocks():
    page = "<div><p>Before it</p><a href=/x><div>Read on here</div><div>And there</div></a><a name=top><p>After it</p><ul><li><a href=/y>Open</ul><p>End</p></div>"
    assert [(b[0], b[2]) for b in html_text.text_blocks(page)] == [
        ("Before it", 0), ("Read on here", 3), ("And there", 2), ("After it", 0), ("Open", 1), ("End", 0)
    ]


def test_block_features_equal_a_plain_listing():
    blocks = [("a b", 2, 1, 0, 1), ("c", 1, 1, 2, 0), ("d e f g", 4, 0, 1, 1)]
    assert html_text.block_features(blocks).tolist() == [
        [2, 0.5, 0, 0, 1, 1, 0, 1], [1, 1, 2, 0.5, 4, 0, 2, 0], [4, 0, 1, 1, 0, 0, 1, 1]
    ]
    assert html_text.block_features([]).shape == (0, 8)


def test_splits_equal_all_splits_tried():
    rng = np.random.default_rng(5)
    for _ in range(30):
        rows, labels = rng.integers(0, 6, (25, 3)).astype(float), rng.integers(0, 2, 25).astype(float)

        def impurity(low):
            return sum(len(x) * x.mean() * (1 - x.mean()) for x in (labels[low], labels[~low]))

        tried = [
            impurity(rows[:, f] < cut)
            for f in range(3)
            for cut in np.arange(0.5, 6)
            if min((rows[:, f] < cut).sum(), (rows[:, f] >= cut).sum()) >= 3
        ]
        split = html_text.best_split(rows, labels, range(3), 3)
        whole = 25 * labels.mean() * (1 - labels.mean())
        if split is None:
            assert min(tried) >= whole - 1e-9
        else:
            assert impurity(rows[:, split[0]] < split[1]) == pytest.approx(min(tried))


def test_densities_are_asked_first_and_places_only_where_they_leave_both():
    """Every block of the labelled table is told right; only leaves with both kinds ask for the place of a block."""
    tree = html_text.BlockTree.fit()
    wrong = alone = total = 0
    for page in html_text.EXAMPLES:
        blocks = html_text.text_blocks(page)
        for block, row in zip(blocks, html_text.block_features(blocks)):
            asked = [f >= html_text.DENSITIES for f in tree.asked(row)]
            assert not asked[0]
            wrong += (tree.share(row) >= 0.5) != block[0].startswith("T")
            alone += not any(asked)
            total += 1
    assert wrong == 0 and alone > total / 10


def test_language_spans(spark, docs):
    english, german = "the house and the garden of my friend ", "der hund und die katze von meinem freund "
    rows = [(i, english * 3, "en") for i in range(20)] + [(i + 20, german * 3, "de") for i in range(20)]
    model = language.LanguageModel.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    spans = next(model.label([english * 2 + german * 4]))
    assert [s[0] for s in spans] == ["en", "de"]
    got = {r.doc_id: r for r in language.identify(docs, model, with_spans=True).collect()}
    assert got[4].lang_pred == got[5].lang_pred == got[6].lang_pred == "und" and 0 <= got[1].score <= 1
    assert language.keep_identified(docs, model).columns == docs.columns


def test_only_texts_without_a_letter_are_undetermined(spark):
    model = language.LanguageModel.fit(spark.createDataFrame([(1, "the house", "en"), (2, "das haus", "de")], "doc_id long, text string, lang string"))
    texts = ["বাংলা", "தமிழ்", "አማርኛ", "ខ្មែរ", "ລາວ", "ᏣᎳᎩ", "Ｆｕｌｌ", "ﬁ", "汉字", "ʻ", "हिन्दी", "1a", "𝒳"]
    none = ["", None, " 12 !? ½ ", "\u0301", "😀", "Ⅷ"]
    frame = spark.createDataFrame(list(enumerate(texts + none)), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identify(frame, model).collect()}
    assert {got[i] for i in range(len(texts))} <= {"en", "de"}
    assert all(got[len(texts) + i] == "und" for i in range(len(none)))


def test_word_scores_equal_a_plain_sum(spark):
    """Learning and scores from n-grams that are listed letter by letter."""
    rows = [(1, "Haus und Hof, Haus", "de"), (2, "the house", "en"), (3, "und", "de")]
    model = language.LanguageModel.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def grams(word):
        padded = "   " + word
        for at in range(3, len(padded)):
            for n in language.GRAMS:
                yield n, tuple(padded[at - n + 1 : at + 1])

    counts = {lang: Counter() for lang in ("de", "en")}
    for _, text, lang in rows:
        for word in re.findall("[a-z]+", text.lower()):
            counts[lang].update(grams(word))
    words = language.Words(["haus hof the"])
    scores = model.word_scores(words)
    # Buckets may be shared by chance only: compare by the exact counts of n-grams.
    total = {lang: sum(c.values()) + 0.5 * (1 << language.BUCKET_BITS) for lang, c in counts.items()}
    for w, word in enumerate(["haus", "hof", "the"]):
        for k, lang in enumerate(model.langs):
            plain = sum(np.log((counts[lang][g] + 0.5) / total[lang]) for g in grams(word))
            assert scores[w, k] == pytest.approx(plain, rel=1e-4)


def test_viterbi_equals_brute_force():
    random = np.random.default_rng(3)
    lengths = [0, 4, 1, 6]
    scores, begins = random.normal(size=(11, 3)) * 3, np.concatenate([[0], np.cumsum(lengths)])
    got = language.viterbi(scores, begins, 1.5)

    def value(path, part):
        return sum(part[i, p] for i, p in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

    for a, b in zip(begins[:-1], begins[1:]):
        paths = [[]]
        for _ in range(b - a):
            paths = [p + [k] for p in paths for k in range(3)]
        best = max(value(p, scores[a:b]) for p in paths)
        assert value(list(got[a:b]), scores[a:b]) == pytest.approx(best)


def test_language_model_counts_and_base(docs):
    from pyspark.sql import functions as F

    role = F.when(F.col("doc_id") == 3, lm.SCORED).when(F.col("doc_id") == 2, lm.WEIGHTS).otherwise(lm.MAIN)
    got = lm.score_documents(docs, role).collect()
    words = {}
    for doc_id, text, *_ in ROWS:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words.setdefault(doc_id, []).append(re.findall(r"[^\x20\x09-\x0d]+", low) + ["<end>"])
    counts = Counter(w for d, lists in words.items() if d != 3 for tokens in lists for w in tokens)
    total, types = sum(counts.values()), len(counts)
    assert len(got) == len(ROWS)
    for r in got:
        tokens = words[r.doc_id][0]
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(tokens), total, sum(w in counts for w in tokens))
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert next(r for r in got if r.doc_id == 3).score > next(r for r in got if r.doc_id == 3).base_score


def test_grades_beyond_the_model_and_below_one(spark, docs):
    model = grades.OrdinalModel(np.zeros((1 << grades.BITS) + 2), np.zeros(1))
    got = grades.grade_documents(docs, model, 2).collect()
    assert len(got) == len(ROWS) and all(r.tail == 0 and not r.selected and r.expected_grade == 0.5 for r in got)
    with pytest.raises(ValueError, match="at least grade 0"):
        grades.grade_documents(docs, model, 0)


def test_learnt_grades_are_the_most_likely_ones(spark):
    """The penalised likelihood, summed text by text, falls when a threshold or a weight is moved."""
    rng = np.random.default_rng(3)
    words = [["bad", "poor", "dull"], ["fair", "plain", "usual"], ["fine", "great", "rich"]]
    rows = []
    for i in range(600):
        # Few different texts whose grades differ, so that the most likely weights are finite.
        kinds, grade = [i % 3, rng.integers(3)], i % 3 if rng.random() < 0.6 else rng.integers(3)
        rows.append((" ".join(words[k][rng.integers(3)] for k in kinds), int(grade)))
    model = grades.OrdinalModel.fit(spark.createDataFrame(rows, "text string, grade int"))

    def loss(weights, thresholds):
        tails = grades.OrdinalModel(weights, thresholds).tails([text for text, _ in rows])
        total = 0.0
        for (_, grade), tail in zip(rows, tails):
            total -= sum(np.log(t if grade > j else 1 - t) for j, t in enumerate(tail))
        return total / len(rows) + grades.PENALTY / 2 * (weights**2).sum()

    best = loss(model.weights, model.thresholds)
    assert best < loss(np.zeros_like(model.weights), model.thresholds) and model.thresholds[0] < model.thresholds[1]
    for j in range(2):
        for step in (-0.4, 0.4):
            assert loss(model.weights, model.thresholds + step * (np.arange(2) == j)) > best
    for bucket in np.argsort(-abs(model.weights))[:5]:
        for step in (-0.5, 0.5):
            assert loss(model.weights + step * (np.arange(len(model.weights)) == bucket), model.thresholds) > best


def test_whole_licence_texts_in_other_layouts_are_found_without_a_shuffle_of_lines(spark):
    texts = [(i, name, text) for i, (name, text) in enumerate(licences.KNOWN) if "\n" in text]
    assert {"BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "BSL-1.0", "MIT", "ISC", "0BSD"} <= {name for _, name, _ in texts}
    changed = [(i, "Copyright (c) 2020 Someone\n" + re.sub(r"(?<=,) ", "\n  * ", text.upper().replace("LICENSE", "LICENCE"))) for i, _, text in texts]
    near = [(100 + i, text + "\nexcept on Sundays") for i, _, text in texts]
    found = licences.licence_matches(spark.createDataFrame(changed + near, "doc_id long, text string"))
    assert {(r.doc_id, r.licence) for r in found.where("line_no = 0").collect()} == {(i, name) for i, name, _ in texts}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_ordinal_grades(spark, docs):
    rows = [(f"bad awful w{i}", 0) for i in range(30)] + [(f"so so w{i}", 1) for i in range(30)] + [(f"good fine w{i}", 2) for i in range(30)]
    model = grades.OrdinalModel.fit(spark.createDataFrame(rows, "text string, grade int"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    expected = model.tails(["bad awful", "so so", "good fine"]).sum(1)
    assert expected[0] < 0.5 < expected[1] < 1.5 < expected[2]
    assert grades.grade_documents(docs, model, 1).count() == len(ROWS)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    model = language.LanguageModel.fit(empty)
    from pyspark.sql import functions as F

    for frame in (
        packing.pack_documents(empty, TOKENIZER),
        sharding.shard_by_bytes(empty),
        quality_rules.quality_verdicts(empty),
        licences.licence_matches(empty),
        decontaminate.benchmark_matches(empty, bench),
        jaccard.similar_components(empty),
        language.identify(empty, model),
        lm.score_documents(empty, F.lit(lm.MAIN)),
        grades.grade_documents(empty, grades.OrdinalModel.fit(empty.select("text", F.lit(1).alias("grade"))), 1),
        html_text.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")),
    ):
        assert frame.count() == 0


def test_counts_above_32_bits_survive():
    values = np.array([0, 1, 2**32 - 1, 2**32, 5_000_000_000, 2**62], np.int64)
    assert (lm._unsqueeze(lm._squeeze(values)) == values).all()


def test_short_passages_match_as_whole_words(spark):
    frame = spark.createDataFrame([(1, "xx Short, ITEM yy short item"), (2, "short items"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "short item"), (8, ""), (9, "!?"), (7, "short item")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontaminate.benchmark_matches(frame, bench).collect())
    assert got == [(1, 7, 3, 13, 0)] * 2 + [(1, 7, 17, 27, 0)] * 2


@settings(max_examples=60, deadline=None)
@given(st.text("abcd ", min_size=24, max_size=70), st.text("abcd ", max_size=30), st.text("abcd ", max_size=30), st.lists(st.tuples(st.integers(0, 69), st.sampled_from("abe")), max_size=4))
def test_filter_loses_no_passage_within_the_budget(item, before, after, edits):
    canonical = decontaminate.canonical(item)
    if len(canonical) < 8:
        return
    index = decontaminate.PassageIndex([(1, canonical)], 8, 0.2)
    changed = list(canonical.decode())
    for place, letter in edits:
        if place < len(changed):
            changed[place] = letter
    text = decontaminate.canonical(before + "".join(changed) + after)
    least = _semi_global(canonical, text)
    found = [e for *_, e in index.matches([text])]
    assert (min(found) == least) if least <= index.budget[0] else not found


AWKWARD = [
    (None, "no id " + SAME, "en", "a", 1, "x"), (None, "no id " + SAME, "en", "a", 1, "x"), (None, "other " + SAME.replace("two", "zwei"), "en", "a", 1, "y"),
    (3, SAME, "en", "a", 1, "z"), (3, SAME, "en", "a", 1, "z"), (3, "### 12 " * 40, "en", "a", 1, "w"), (4, None, None, None, None, None),
    (5, "", "en", "b", 0, "v"), (6, " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9000)), "fr", "c", 1, "u"),
]


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_rows(spark, stage, tmp_path):
    """Rows without an id, repeated rows, different rows of one id, further columns, empty tables."""
    root = str(tmp_path)
    spark.createDataFrame([(1, "a passage that is nowhere in these documents at all")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
    function = dict(corpus_pipeline.STAGES)[stage]
    frame = spark.createDataFrame(AWKWARD, schema)
    got = Counter(map(tuple, function(spark, frame, root).collect())) if stage != "pack" else None
    every = Counter(AWKWARD)
    if stage == "quality":  # too many repeats, or too few words
        assert got == Counter([AWKWARD[8]])
    elif stage == "language":
        assert got == every - Counter(AWKWARD[5:8])
    elif stage == "near_copies":  # one of equal rows, and of SAME and its near copies the least id
        assert sum(got.values()) == len(got) and AWKWARD[3] in got and AWKWARD[6] in got and AWKWARD[8] in got
    elif stage == "benchmark_passages":
        assert got == every
    assert function(spark, frame.limit(0), root).count() == 0


def test_pipeline_keeps_whole_documents(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    frame, seen = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, root)
        assert frame.columns == docs.columns
        seen.append(frame.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    assert frame.exceptAll(docs).isEmpty()
    packed = corpus_pipeline.run(spark, root)
    assert packed.select("doc_id").distinct().count() == seen[-1]
