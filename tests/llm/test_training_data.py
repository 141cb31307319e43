"""Training-data operators against brute force and worked cases, nulls and clashes included."""

import itertools
import random
from collections import Counter, defaultdict

import hypothesis.strategies as st
import numpy as np
import pytest
from hypothesis import given, settings

from corpusloom.llm import bpe, canon, leak, pairs, residue, surface, terms, topn

# --- 1 ------------------------------------------------------------------------------------

ODD = "_g string, _i string, _s double, rank int, rate double"


def brute_top(rows, n):
    best = defaultdict(dict)
    for g, i, s in rows:
        if g is not None and i is not None and s is not None and s == s:
            best[g][i] = max(s, best[g].get(i, -1e300))
    return {(g, i, k + 1) for g, items in best.items() for k, (i, _) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:n])}


def test_top_per_group(spark):
    rng = random.Random(1)
    rows = [(f"g{rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])}", f"i{rng.randrange(30)}", rng.choice([0.0, 0.5, 1.0, rng.random(), None, float("nan")])) for _ in range(600)]
    rows += [(None, "x", 1.0), ("g1", None, 2.0), ("only", "a", 0.1), ("only", "a", 0.1)]
    df = spark.createDataFrame([(g, i, s, 7, s) for g, i, s in rows], ODD)
    got = {(r["_g"], r["_i"], r["rank"]) for r in topn.top_per_group(df, "_g", "_i", "_s", 4).collect()}
    assert got == brute_top(rows, 4)
    assert topn.top_per_group(df.limit(0), "_g", "_i", "_s", 4).count() == 0


def test_bands_are_few_and_falling(spark):
    df = spark.createDataFrame([(f"g{k % 5}", k / 1000) for k in range(1000)], "_g string, _s double")
    edges = topn.band_edges(df, 10)
    assert edges == sorted(edges, reverse=True) and 1 <= len(edges) <= 3


# --- 2 ------------------------------------------------------------------------------------


def brute_pairs(rows):
    baskets = defaultdict(set)
    for g, b, i in rows:
        if None not in (g, b, i):
            baskets[g, b].add(i)
    n, single, both = Counter(), Counter(), Counter()
    for (g, _), items in baskets.items():
        n[g] += 1
        single.update((g, i) for i in items)
        both.update((g, a, b) for a, b in itertools.combinations(sorted(items), 2))
    return {(g, a, b, n[g], single[g, a], single[g, b], c) for (g, a, b), c in both.items()}


@pytest.mark.parametrize("block", [2048, 3])
def test_pair_counts(spark, block):
    rng = random.Random(2)
    rows = [(f"g{rng.randrange(3)}", f"b{rng.randrange(12)}", f"i{rng.randrange(14)}") for _ in range(300)]
    rows += [("g0", "hot", f"i{k}") for k in range(14)] + [(None, "b", "i"), ("g", None, "i"), ("g", "b", None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "occ string, b string, i string, n int, g int")
    got = {tuple(r) for r in pairs.pair_counts(df, "occ", "b", "i", block=block).collect()}
    assert got == brute_pairs(rows)
    assert pairs.pair_counts(df.limit(0), "occ", "b", "i").count() == 0
    found = {tuple(r)[:7] for r in pairs.associated_pairs(df, "occ", "b", "i", 2, 2, block).collect()}
    assert found == {r for r in got if r[6] >= 2 and r[6] * r[3] >= 2 * r[4] * r[5]} and found


def test_pair_counts_beyond_limits(spark, monkeypatch):
    """Codes of two columns and items pruned by a join give the same pairs."""
    rng = random.Random(5)
    rows = [(f"g{rng.randrange(3)}", f"b{rng.randrange(12)}", f"i{rng.randrange(14)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, b string, i string")
    wanted = {tuple(r) for r in pairs.pair_counts(df, "g", "b", "i", 3, 1).collect()}
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", 2)
    assert {tuple(r) for r in pairs.pair_counts(df, "g", "b", "i", 3, 1, block=4).collect()} == wanted and wanted


def test_wide_codes():
    runs = pairs._runs(np.array([5, 5, 3]), np.array([1, 1, 2]))
    assert runs.values.tolist() == [[1, 5, 2], [2, 3, 1]]


def test_odds_ratio(spark):
    df = spark.createDataFrame([(100, 10, 10, 10)], "n long, n_a long, n_b long, n_ab long")
    row = pairs.with_association(df).first()
    assert row["lift"] == 10.0 and row["odds_ratio"] == pytest.approx((10.5 * 90.5) / (0.5 * 0.5))


# --- 3 ------------------------------------------------------------------------------------

LIST = [(1, "tabular querying", ["taq"]), (2, "stress-testing", []), (3, "glacier drafting", []), (4, "runway mapping", ["zalmoreth"]), (5, "notebook migration", [])]


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("Tabular Querying", 1), ("TAQ", 1), ("T.A.Q.", 1), ("taq (tabular querying)", 1), ("querying, tabular", 1), ("tabualr queryin", 1),
        ("ｔａｂｕｌａｒ　ｑｕｅｒｙｉｎｇ", 1), ("tab ular querying", 1), ("hands-on stress testing", 2), ("stresstesting tools", 2), ("certifiedinstresstesting", 2),
        ("good comand of runway maping", 4), ("zalmorth", 4), ("note book migration (advanced)", 5), ("migration of notebook", 5), ("  notebook_migration®", 5),
        ("tabular drafting", -1), ("runway glacier drafting", -1), ("must be reliable", -1), ("???", -1), ("", -1), ("tak", -1), ("x" * 5000, -1),
    ],
)
def test_canonical_values(value, wanted):
    assert mapped(LIST, value, "hands on tools certified in good command of advanced".split()) == wanted


def mapped(entries, value, frame=()):
    answer = canon.Matcher(entries, canon.ListWords(canon.name_words(entries)), frame).answer(value)
    return -1 if answer is None else answer.key


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
@settings(max_examples=300)
def test_edit_distance(a, b):
    table = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            cost = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                cost = min(cost, table[i - 2, j - 2] + 1)
            table[i, j] = cost
    assert canon.edit_distance(a, b, 20) == table[len(a), len(b)]


def test_longest_mentions_win():
    entries = [(1, "alpha", []), (2, "alpha beta", []), (3, "beta gamma delta", ["alpha two"])]
    matcher = canon.Matcher(entries, canon.ListWords(canon.name_words(entries)))
    assert [tuple(m) for m in matcher.mentions("so alpha beta x alpha".split())] == [(2, 9, ("so", "x", "alpha")), (1, 5, ("so", "alpha", "beta", "x"))]
    assert [tuple(m) for m in matcher.mentions("betagammadelta alphatwo".split())] == [(3, 14, ())]
    assert matcher.mentions(["xbetay"]) == [] and matcher.mentions([]) == []


def test_mentions_in_other_words_and_orders(spark):
    entries = [(1, "quorgais", None), (2, "rail review", None), (3, "nested cargo audit rail planning", None), (4, "zun quorgais lamp", None)]
    found = [mapped(entries, v) for v in ("5 years quorgais in production", "Kenntnisse in quorgais", "quorgais lamp", "quorgais lanp", "quorgais reviw")]
    assert found == [1, 1, -1, -1, -1]
    orders = ("planning rail audit cargo nested", "planning rail audit cargp nested", "cargo planing rail audit nested", "planing rial audit nested cargo")
    assert [mapped(entries, v) for v in orders] == [3, 3, 3, 3]
    longer = [(1, "one two three four five six seven eight", None)]
    assert mapped(longer, "eight seven six five four three two one") == 1 and mapped(longer, "eigth seven six five four threee two one") == 1
    values = spark.createDataFrame([(1, "revew doing rail")], "r long, v string")
    listed = spark.createDataFrame([("e2", "rail review")], "e string, n string")
    got = [canon.map_values(values, "r", "v", listed, "e", "n", frame=f).first()["e"] for f in ((), {"doing"})]
    assert got == ["-1", "e2"]


def test_frame_is_learned_and_shards_agree(spark):
    words = ["alder", "birch", "cedar", "dogwood", "elm", "fir", "ginkgo", "hazel", "ironwood", "juniper"]
    entries = [(i, f"{a} {b}", [f"{b}{i}x"]) for i, (a, b) in enumerate(zip(words, [f"{w}ling" for w in reversed(words)]))]
    listed = spark.createDataFrame(entries, "e long, n string, o array<string>")
    shown = [(0, f"years of {n} daily", k) for k, n, _ in entries] + [(1, f"{n.split()[0]}e {n.split()[1]}", k) for k, n, _ in entries]
    shown += [(2, f"yeras of {n.replace('li', 'il')} dayly", k) for k, n, _ in entries] + [(3, "alder elmling", -1), (4, "alder juniperling", 0), (5, "fir", -1)]
    df = spark.createDataFrame([(i, v) for i, (_, v, _) in enumerate(shown)], "r long, v string")
    wanted = {i: k for i, (_, _, k) in enumerate(shown)}
    for size in (100_000, 7, 3):
        assert dict(canon.map_values(df, "r", "v", listed, "e", "n", "o", shard_names=size).collect()) == wanted


def test_map_values(spark):
    entries = spark.createDataFrame([*LIST, (None, "x", None), (9, None, None)], "r long, v string, e array<string>")
    df = spark.createDataFrame([(1, "taq", "a"), (2, None, "b"), (3, "", "c"), (1, "taq", "a")], "id long, v string, e string")
    assert sorted(map(tuple, canon.map_values(df, "id", "v", entries, "r", "v", "e").collect())) == [(1, 1), (1, 1), (3, -1)]
    assert sorted(map(tuple, canon.map_values(df, "id", "v", entries.limit(0), "r", "v", "e").collect())) == [(1, -1), (1, -1), (3, -1)]
    assert canon.map_values(df.limit(0), "id", "v", entries, "r", "v", "e").count() == 0


# --- 4 ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("ａｂｃ", "abc", True), ("é", "é", True), ("a​b", "ab", True), ("a b", "a b", True), (" a ", "a", True), ("соlumn", "column", True),
        ("ｶﾞ", "ガ", True), ("Ёx", "Ëx", True), ("A", "a", False), ("e", "é", False), ("x²", "x2", False), ("½", "1⁄2", False), ("a  b", "a b", False), ("a-b", "a b", False),
        ("a\0b", "a\0c", True), ("​", "", True),
    ],
)
def test_visual_key(a, b, same):
    same = same and (a, b) != ("a\0b", "a\0c")
    assert (surface.visual_key(a) == surface.visual_key(b)) == same
    if same:
        assert surface.fold_key(a) == surface.fold_key(b)


@given(st.text(max_size=12))
def test_keys_are_stable(text):
    seen = surface.visual_key(text)
    assert surface.visual_key(seen) == seen
    assert surface.fold_key(seen) == surface.fold_key(text)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_same_looking_pairs(spark, hot):
    forms = ["abc", "аbc", "ａbc", "abc", "ab​c", "xyz", "xyz", None, "", "​", "a\0b", "a\0c"]
    rows = [(k, f, "s") for k, f in enumerate(forms)] + [(0, "abc", "s"), (None, "abc", "s")]
    df = spark.createDataFrame(rows, "id long, _text string, _seen string")
    want = {(a, b) for a, b in itertools.combinations(range(len(forms)), 2) if None not in (forms[a], forms[b]) and forms[a] != forms[b] and surface.visual_key(forms[a]) == surface.visual_key(forms[b])}
    got = [tuple(r) for r in surface.same_looking_pairs(df, "id", "_text", hot).collect()]
    assert set(got) == want and len(got) == len(want)
    assert surface.same_looking_pairs(df.limit(0), "id", "_text").count() == 0


# --- 5 ------------------------------------------------------------------------------------


def test_value_frequencies(spark):
    rows = [(1, "a b", 2), (1, "a b", 2), (2, "a b", None), (3, "a", 1), (4, None, 9), (5, "", 4), (6, " a", 1), (7, "a\0b", 1), (8, "a\0c", 1), (9, "n", None)]
    df = spark.createDataFrame(rows, "suffix int, v string, total long")
    got = {r["v"]: (r["total"], r["rows"]) for r in terms.value_frequencies(df, "v", "total").collect()}
    assert got == {"a b": (2, 2), "a": (1, 1), "": (4, 1), " a": (1, 1), "a\0b": (1, 1), "a\0c": (1, 1), "n": (0, 1)}
    marks = {r["v"]: r["mark"] for r in terms.uninformative_values(df, "v", "total").collect()}
    assert marks == {"a b": "rare", "a": "rare", "": "common", " a": "rare", "a\0b": "rare", "a\0c": "rare", "n": "rare"}
    assert terms.uninformative_values(df.limit(0), "v", "total").count() == 0


def test_ngrams_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["a " + " ".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in range(200)] + [None, "", "  ", "a\0b c"]
    df = spark.createDataFrame([(t, 1) for t in texts], "v string, w int").repartition(3)
    total, held = Counter(), defaultdict(set)
    for k, t in enumerate(texts):
        w = [x for x in (t or "").split(" ") if x]
        for n in (1, 2, 3):
            for s in range(len(w) - n + 1):
                total[" ".join(w[s : s + n])] += 1
                held[" ".join(w[s : s + n])].add(k)
    got = {r["gram"]: (r["total"], r["rows"]) for r in terms.ngram_frequencies(df, "v", 3, 2).collect()}
    assert got == {g: (c, len(held[g])) for g, c in total.items() if len(held[g]) >= 2}


def test_rare_and_long_ngrams_are_marked(spark):
    rows = [("a b c d e", 1), ("a b", 1), ("a", 5), ("a", 5), (None, 9)]
    df = spark.createDataFrame(rows, "v string, w int")
    got = {r["gram"]: (r["n"], r["total"], r["rows"], r["mark"]) for r in terms.marked_ngrams(df, "v").collect()}
    assert len(got) == 15 and got["a"] == (1, 4, 4, "common") and got["a b"] == (2, 2, 2, "rare") and got["a b c d e"] == (5, 1, 1, "rare")
    assert {tuple(r) for r in terms.marked_values(df, "v", "w", 2, 0.5).collect()} == {("a b c d e", 1, 1, "rare"), ("a b", 1, 1, "rare"), ("a", 5, 1, None)}
    assert terms.marked_ngrams(df.limit(0), "v").count() == 0


# --- 6 ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    try:
        t = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    except Exception:
        pytest.skip("no vocabulary files here")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


HARD = ["", "aaaaaaaaaaa", "ab" * 700, "<|endoftext|> x", " \n\t  y", "naïve café ½ ²", "👩🏽‍💻 日本語 한국어 عربى", "I'll we're DON'T", "x" * 20_000, "0123456789 1,000.50"]


def test_encoding_equals_the_library(reference):
    encoder = bpe.Encoder(bpe.load_merges())
    assert encoder.encode_batch(HARD) == [reference(t) for t in HARD]
    assert encoder.encode_batch([None]) == [[]]


def test_encoding_of_any_text(reference):
    encoder = bpe.Encoder(bpe.load_merges(), kept=50)

    @given(st.text(max_size=40))
    @settings(max_examples=200)
    def check(text):
        assert encoder.encode_batch([text])[0] == reference(text)

    check()


def test_encode_table(spark, reference):
    df = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (3, "", 1), (None, "c", 1)], "id long, text string, ids int")
    assert {r["id"]: r["ids"] for r in bpe.encode(df, "id", "text").collect()} == {1: reference("a b"), 2: [], 3: [], None: reference("c")}
    assert bpe.encode(df.limit(0), "id", "text").count() == 0


# --- 7 ------------------------------------------------------------------------------------


def test_leaks_against_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 60])))) for k in range(40)]
    texts = []
    for k in range(150):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        source = rng.choice(items)[1].split()
        run = rng.choice([0, 5, 10, 11, 12, 13, 25])
        start = rng.randrange(max(1, len(source) - run))
        part = source[start : start + run]
        at = rng.randrange(len(own) + 1)
        words = own[:at] + part + own[at:]
        texts.append((k, rng.choice([" ", "\n", " - ", "</p><p>", "​ **"]).join(words).upper() if rng.random() < 0.5 else ", ".join(words)))
    texts += [(900, None), (901, ""), (None, items[1][1])]
    runs = defaultdict(set)
    for key, text in items:
        w = leak.words_of(text)
        for s in range(len(w) - 11):
            runs[tuple(w[s : s + 12])].add(key)
    want = {(d, i) for d, t in texts if d is not None and t for w in [leak.words_of(t)] for s in range(len(w) - 11) for i in runs.get(tuple(w[s : s + 12]), ())}
    corpus = spark.createDataFrame([(d, t, 1) for d, t in texts], "i long, t string, d int")
    tests = spark.createDataFrame([*items, (None, "x"), (77, None)], "d long, t string")
    for block, busy in ((1000, 200_000), (15, 200_000), (2, 3)):
        monkeypatch.setattr(leak, "BUCKET_PASSAGES", busy)
        got = [tuple(r) for r in leak.leaked_items(corpus, "i", "t", tests, "d", "t", block_items=block).collect()]
        assert set(got) == want and len(got) == len(want) > 20
    for run in (1, 2, 30):
        few = {tuple(r) for r in leak.leaked_items(corpus, "i", "t", tests, "d", "t", run, block_items=5).collect()}
        assert few == {tuple(r) for r in leak.leaked_items(corpus, "i", "t", tests, "d", "t", run).collect()}
    assert leak.leaked_items(corpus, "i", "t", tests.limit(0), "d", "t").count() == 0
    assert leak.leaked_items(corpus.limit(0), "i", "t", tests, "d", "t").count() == 0


def test_words_of_marked_up_text():
    assert leak.words_of("one <a title='" + "x " * 300 + "'>two</a>") == ["one", "two"]
    assert leak.words_of("d&eacute;veloppement infor&shy;mation caf&#233; &#xE9;t&#XE9; a&nbsp;b x&amp;y p&nosuch;q &lt;b&gt;") == [
        "développement", "information", "café", "été", "a", "b", "x", "y", "p", "q", "b",
    ]


@pytest.mark.parametrize(
    "text",
    [
        "d&eacute;veloppement infor&shy;mation caf&#233; &#xE9;t&#XE9; a&nbsp;b x&amp;y p&nosuch;q &lt;b&gt;", "one <a title='" + "x " * 300 + "'>two</a> &thickapprox; z",
        "a&CounterClockwiseContourIntegral;b", "", "  ", "Zero\u200bwidth ÉTÉ e\u0301",
    ],
)
def test_sql_of_words_is_the_code(text):
    duckdb = pytest.importorskip("duckdb")
    from corpusloom.llm import queries

    sql = f"WITH names AS (SELECT {queries._entities()} AS entities) SELECT {queries._p7_words('t')} FROM (SELECT ? AS t) s"
    assert duckdb.connect().execute(sql, [text]).fetchone()[0] == leak.words_of(text)


def test_wand_loses_nothing():
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(20))) for k in range(70)]
    index = leak.ItemIndex(items, 4)
    for _ in range(60):
        query = {rng.randrange(len(index.terms)) for _ in range(rng.randrange(1, 8))}
        for threshold in (0.5, 1.0, 1.7):
            score = Counter()
            for t in query:
                for i, w in zip(*index.postings[t]):
                    score[i] += w
            assert index.retrieve(query, threshold) == sorted(i for i, s in score.items() if s >= threshold - 1e-9)


# --- 8 ------------------------------------------------------------------------------------

RESIDUE = [
    "Join {{company_name}} in this role", "Salary: ${salary}", "About [city]: we care", "Lieu : undefined", "Arbeitsort: __Firmenname__", "Salary: %s", "Join {0} now", "<insert dept>",
    "Duties: XXXX XXXXX XXX", "Lorem ipsum vadem tolor sint, quasi merdum.", "tbd tbd tbd", "Blindtext steht hier, bis der richtige Text kommt", "Text goes here",
    "404 - the page you asked for could not be found", "Seite nicht gefunden. Zurück", "Access denied", "OOPS! SOMETHING WENT WRONG ON OUR SIDE.", "Página no encontrada",
    "Please enable JavaScript to view this page.", "<noscript>This board requires scripting support.</noscript>", "This app will not work without JS - see your browser settings", "Veuillez activer JavaScript pour afficher cette offre.",
]
CONTENT = [
    "You know how to fill templates such as {{ name }} in Foo without leaving gaps", "Experience with placeholders ($1, %s, ?) in Foo statements", "Pay: $9,000 [gross] (negotiable)", "Clerk (m/f/d) [remote] <b>contract</b>",
    "rail data: arrays [0], maps {k: v}, generics List<Row>", "Replace lorem ipsum in 10 mock-ups with copy from the rail desk", "Our portal needs JavaScript skills, Foo and some drafting", "We count 404 staff in Kelby",
    "Handle 404 and 500 errors in our Foo gateway gracefully", "Explain why a page could not be found in Foo search, and fix it", "Write JavaScript that still works when scripts are switched off", "Size XXL server rooms, 100% renewable",
    "<p>Some Foo administration, error handling and retry logic</p>", "You test test plans for rail review", "Short.", "", None,
]


def test_residue_is_told_from_content():
    labels = residue.label_all(RESIDUE + CONTENT * 3)
    assert [t for t, label in zip(RESIDUE, labels) if label is None] == []
    assert [t for t, label in zip(CONTENT, labels[len(RESIDUE) :]) if label is not None] == []


def test_residue_table(spark):
    body = "We look after rail sites. Own the review jobs that feed our reports.\n"
    texts = {k: body + t if t is not None else None for k, t in enumerate(RESIDUE + CONTENT)}
    long = {1000: body * 3000, 1001: body * 3000 + "\n- tbd tbd tbd"}
    df = spark.createDataFrame([(k, t, "x") for k, t in (texts | long).items()] + [(None, RESIDUE[0], "x")], "d long, t string, label string").repartition(3)
    assert {r["d"] for r in residue.residue(df, "d", "t").collect()} == {*range(len(RESIDUE)), 1001}
    left = residue.without_residue(df, "d", "t")
    assert left.columns == df.columns and left.count() == len(CONTENT) + 2
    assert residue.residue(df.limit(0), "d", "t").count() == 0


def test_filler_of_any_wording():
    filler = [
        "Beispieltext Beispieltext Beispieltext", "Profile\n1. Mustertext Mustertext", "2) Proefzin proefzin, PROEFZIN", "Zde bude text. Zde bude text. Zde bude text.\nWe look after rail sites.",
        "Pellentesque habitant morbi tristique senectus et netus et malesuada fames", "At vero eos et accusamus et iusto odio dignissimos ducimus",
    ]
    content = ["\t\tcol1\tcol2\t\tcol3", "go go go rail sites", "0 0 0 0", "x x x", "Duties duties", "Error at id 5", "Schreiben Sie einen Beispieltext für Foo"]
    labels = residue.label_all(filler + content * 3)
    assert labels[: len(filler)] == ["filler"] * len(filler)
    assert [t for t, label in zip(content, labels[len(filler) :]) if label is not None] == []


def test_slots_of_any_length_and_dialect():
    slots = [
        "Join {{ company | upper }} in this role", 'Role: {{ job_title | default: "x" }}', "Salary: {{ pay; currency }} a year", "{% if a.b! c %} Duties", "Pay ${" + "a_b " * 40 + "}",
        "[Insert a two-sentence description of the team, its tools and the way it works here]", "<Insert the name. Then the place; or | both>", "[Insert " + "many words " * 5000 + "]",
    ]
    content = [
        "You know how to fill templates such as {{ name | upper }} in Foo without leaving gaps", "a < b. We look after sites; growth > 5", "<|endof  text here text|>", "[" * 200_000, "Sites {{ and\nreports }}", "[Our rail desk looks after sites of many kinds; it reports on each of them every month]",
    ]
    long_text = "[Our rail desk looks after sites of many kinds. The page you requested could not be found; try again later]"
    labels = residue.label_all([*slots, long_text, *content * 3])
    assert labels[: len(slots)] == ["placeholder"] * len(slots)
    assert labels[len(slots)] == "error page"
    assert [t[:40] for t, label in zip(content, labels[len(slots) + 1 :]) if label is not None] == []
