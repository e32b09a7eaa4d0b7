"""Each operator against a brute-force version, a round trip, or held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageflow.llm import bpe, chunks, decontaminate, html_blocks, html_crf, jaccard, quality_fm, quality_rules, secrets, shards
from pageflow.llm.components import components
from pageflow.llm.queries import QUERIES, table, tokenizer_path
from pageflow.llm.shingles import shingle_sets

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()}


# --- 1: chunks ---------------------------------------------------------------------------

def test_repeats_equal_brute_force(spark, texts):
    places = collections.defaultdict(list)
    for i, t in texts.items():
        data = (t or "").encode()
        if data:
            ends = chunks.borders(data).tolist()
            for a, b in zip([0, *ends], ends):
                places[data[a:b]].append((i, a, b))
    want = set()
    for found in places.values():
        if len(found) > 1:
            first = min(found)
            want |= {(i, a, b, (i, a, b) != first) for i, a, b in found}
    runs, last = [], None
    for i, a, b, removed in sorted(want):
        if last and last[0] == i and last[2] == a and last[3] == removed:
            last[2] = b
        else:
            last = [i, a, b, removed]
            runs.append(last)
    want = {(i, len(texts[i].encode()[:a].decode()), len(texts[i].encode()[:b].decode()), r) for i, a, b, r in runs if b - a >= chunks.MIN_RUN}
    got = QUERIES["op1_chunks"](spark, SMALL).collect()
    assert {(r["doc_id"], r["start"], r["end"], r["removed"]) for r in got} == want and len(got) == len(want)


def test_borders_resist_shifts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    caught = 0
    for _ in range(300):
        passage = " ".join(rng.choices(vocabulary, k=51))
        sides = []
        for _ in range(2):
            data = " ".join([*rng.choices(vocabulary, k=rng.randint(3, 40)), passage, *rng.choices(vocabulary, k=20)]).encode()
            ends = chunks.borders(data).tolist()
            sides.append([data[a:b] for a, b in zip([0, *ends], ends)])
        known, best, run = set(sides[0]), 0, 0
        for c in sides[1]:
            run = run + len(c) if c in known else 0
            best = max(best, run)
        caught += best >= chunks.MIN_RUN
    assert caught >= 297


# --- 2: Jaccard --------------------------------------------------------------------------

def test_shingle_sets_equal_sets_of_tuples(texts):
    rows = [*texts.values(), None, "", " \n", "A b", "a B", "One two\x0bthree\tFOUR five", "é É"]
    made = shingle_sets(pa.array(rows, pa.string()))

    def brute(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [brute(t) for t in rows]
    assert [len(s) for s in made] == [len(s) for s in sets]
    for i in range(len(rows) - 1):
        assert len(np.intersect1d(made[i], made[i + 1])) == len(sets[i] & sets[i + 1])


def test_blocks_keep_all_connections():
    rng = np.random.default_rng(2)
    base = np.arange(60, dtype=np.uint64)
    members = []
    for k in range(300):
        s = np.unique(np.concatenate([rng.choice(base, rng.integers(40, 60), replace=False), rng.integers(100, 400, 9).astype(np.uint64)]))
        members.append({"class": k, "tokens": s.tobytes()})
    a, b = jaccard.Block(members[:170]), jaccard.Block(members[170:])
    found = [e for x, y in ((a, a), (a, b), (b, b)) for e in jaccard.block_links(x, y)]
    sets = a.sets + b.sets

    def parts(edges):
        parent = list(range(300))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for u, v in edges:
            u, v = sorted((root(u), root(v)))
            parent[v] = u
        return [root(x) for x in range(300)]

    every = []
    for i in range(300):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                every.append((j, i))
    assert every and set(map(tuple, map(sorted, found))) - {(k, k) for k in range(300)} <= set(every)
    assert parts(found) == parts(every)


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v").union(spark.createDataFrame([(1000, 1001)], "u long, v long"))
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(400)}, 1000: 1000, 1001: 1000}


# --- 3: BPE ------------------------------------------------------------------------------

def test_bpe_equals_the_library(texts):
    from tokenizers import Tokenizer

    library, spec = Tokenizer.from_file(tokenizer_path()), open(tokenizer_path(), encoding="utf-8").read()
    encoder, decoder = bpe.BpeEncoder(spec), bpe.BpeDecoder(spec)
    rng, vocabulary = random.Random(5), sorted(library.get_vocab())
    made = [t or "" for t in texts.values()]
    for letters in ("abcdefgh ", "aab", " e's're'LL12", "éÀßΣσς İǺ̈́ ", "\x1c\x1d\x85\xa0a ", "中カ글😀𐵐ՠ ", "!?.,;-()\"ab "):
        made += ["".join(rng.choices(letters, k=rng.randint(0, 50))) + rng.choice(vocabulary) for _ in range(300)]
    made += ["<|endoftext|>", "a<|startoftext|>b <|endoftext|", "x" * 30_000, "the" * 9_000]
    for text in made:
        want = library.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert got.tolist() == want and decoder.decode(got).decode() == library.decode(want, skip_special_tokens=False)


# --- 4: HTML -----------------------------------------------------------------------------

def test_crf_on_held_out_pages():
    model = html_crf.train()
    wrong = total = 0
    for found, labels in html_blocks.labelled_pages(200, 12345):
        total += len(labels)
        wrong += sum(a != b for a, b in zip(model.decode(found), labels))
    assert wrong <= 0.01 * total
    prose = "The fox ran over the hill. It was late, and it was dark. "
    page = (f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class=cookie-notice><p>{prose}</p></div><article><h1>A &lt;title&gt;</h1>"
            f"<p>{prose}<br>more\n  text</p><form><label>Mail</label></form></article><div id=comments><p>{prose}</p></div><footer>&copy; me</footer>")
    assert html_crf.main_text(model, page) == "A <title>\n" + prose + "more text"


def test_head_without_end_tag_and_formulas():
    model = html_crf.train()
    prose = "The fox ran over the hill. It was late, and it was dark. "
    article = f"<article><h1>Foxes</h1><p>{prose}</p><p>{prose}</p></article><footer>&copy; me</footer>"
    want = "\n".join(["Foxes", prose.strip(), prose.strip()])
    for start in ("<html><head><title>t</title><body>", "<html><head><meta charset=utf-8><title>t</title><script>var t='<p>';</script>",
                  "<head><title>t</title><noscript><body>", "<html><head><title>t</title></head><body>"):
        assert html_crf.main_text(model, start + article) == want
    assert [x.text for x in html_blocks.leaves("<head><title>t</title>plain text")] == ["plain text"]
    formula = ("<p>So <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds, as <svg><style>x{}</style><text>the axis</text></svg> "
               f"shows. <object data=x.pdf>See the paper.</object> {prose}</p>")
    text = html_crf.main_text(model, f"<html><head><title>t</title><body><article><h1>Foxes</h1><p>{prose}</p>{formula}</article>")
    assert text == f"Foxes\n{prose.strip()}\nSo E=m holds, as the axis shows. See the paper. {prose.strip()}"


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    model = html_crf.Crf({}, np.zeros((0, 2)), rng.normal(size=(2, 2)))
    for n in (1, 2, 5, 8):
        scores = rng.normal(size=(n, 2))
        model.scores = lambda _: scores
        def total(path):
            return sum(scores[i, y] for i, y in enumerate(path)) + sum(model.steps[a, b] for a, b in zip(path, path[1:]))
        paths = [[k >> i & 1 for i in range(n)] for k in range(1 << n)]
        found = [html_blocks.Leaf("x", "p", frozenset(), frozenset(), "", 0, "")] * n
        assert model.decode(found) == max(paths, key=total)


def test_html_articles_of_the_table(spark):
    import html as H

    def brute(page):
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1|article)>", inner.replace("<br>", " "))
        return "\n".join(x for p in parts if (x := " ".join(H.unescape(re.sub(r"<[^>]+>", "", p)).split())))

    pages = {r["page_id"]: r["html"] for r in table(spark, MEDIUM, "pages").collect()}
    rows = QUERIES["op4_html_crf"](spark, MEDIUM).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == brute(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


# --- 5: decontamination ------------------------------------------------------------------

def test_alignment_equals_plain_smith_waterman():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 25))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
                t[i][j] = max(0, t[i - 1][j - 1] + same, t[i - 1][j] + decontaminate.GAP, t[i][j - 1] + decontaminate.GAP)
        assert decontaminate.align(a, b)[0] == max(map(max, t))


def test_leaks_equal_alignment_of_all_pairs(spark, texts):
    items = {r["item_id"]: r["text"] for r in table(spark, SMALL, "benchmark").collect()}
    number: dict[bytes, int] = {}
    def ids(t):
        return np.array([number.setdefault(w, len(number)) for w in decontaminate.words_of(t)], np.int64)
    tests = {i: ids(t) for i, t in items.items()}
    want = set()
    for d, t in texts.items():
        doc = ids(t)
        for i, item in tests.items():
            if len(item) and len(doc) and decontaminate.is_leak(*decontaminate.align(item, doc)[:2], len(item)):
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontaminate"](spark, SMALL).collect()}
    assert want and got == want


def test_edited_copies_are_leaks(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 8))) for _ in range(600)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(20, 50)))) for i in range(40)]
    docs = []
    for i, text in items:
        edited = [w if rng.random() > 0.2 else rng.choice(["", rng.choice(vocabulary)]) for w in text.split()]
        docs.append((i, " ".join([*rng.choices(vocabulary, k=60), *edited, *rng.choices(vocabulary, k=60)])))
        docs.append((1000 + i, " ".join(rng.choices(vocabulary, k=150))))
    rows = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(found & {(i, i) for i in range(40)}) >= 38 and all(d < 1000 for d, _ in found)


def test_hot_half_of_an_item_is_a_leak():
    rng = random.Random(4)
    words = ["w%d" % i for i in range(39)]
    other = lambda n: ["x%d" % rng.randrange(10**6) for _ in range(n)]
    items = decontaminate.Items([(1, " ".join(words)), (2, " ".join(other(30)))])
    docs = [words] + [[*other(50), *words[-20:], *other(50)] for _ in range(50)]
    found = [decontaminate.leaks_of(items, " ".join(d)) for d in docs]
    assert [(x["item_id"], x["matches"]) for f in found for x in f] == [(1, 39)] + [(1, 20)] * 50
    third = [w if i % 3 else "new" for i, w in enumerate(words)]  # no three words of the item in a row
    apart = [x for w in words for x in (w, "new")]
    assert all([x["item_id"] for x in decontaminate.leaks_of(items, " ".join(other(40) + d + other(40)))] == [1] for d in (third, apart))


def test_bounds_lose_no_leak():
    rng = np.random.default_rng(5)
    for _ in range(40):
        rows = [(k, " ".join(map(str, (30 * rng.random(rng.integers(1, 45)) ** 2).astype(int)))) for k in range(6)]
        items = decontaminate.Items(rows)
        words = (40 * rng.random(rng.integers(1, 150)) ** 2).astype(int)
        for k in rng.integers(0, 6, 2):
            copied = [w if rng.random() > 0.25 else str(rng.integers(0, 60)) for w in rows[k][1].split() if rng.random() > 0.1]
            at = rng.integers(0, len(words) + 1)
            words = np.concatenate([words[:at], np.array(copied, int), words[at:]])
        text = " ".join(map(str, words))
        number = items.numbered(text)
        want = {k for k, w in enumerate(items.words) if len(w) >= decontaminate.WHOLE_WORDS
                and decontaminate.is_leak(*decontaminate.align(w, number)[:2], len(w))}
        assert want <= {x["item_id"] for x in decontaminate.leaks_of(items, text)}


def test_every_copy_close_by_is_a_leak():
    words = ["w%d" % i for i in range(30)]
    items = decontaminate.Items([(1, " ".join(words)), (2, "alone")])
    for times, gap in ((2, 20), (2, 0), (100, 0), (1000, 1)):
        text = " ".join(["before", *[w for _ in range(times) for w in [*words, *["x"] * gap]], "alone alone"])
        found = decontaminate.leaks_of(items, text)
        assert [(x["item_id"], x["start_word"], x["end_word"]) for x in found] == [
            *[(1, 1 + k * (30 + gap), 31 + k * (30 + gap)) for k in range(times)],
            *[(2, 1 + times * (30 + gap) + k, 2 + times * (30 + gap) + k) for k in (0, 1)]]


# --- 6: secrets --------------------------------------------------------------------------

def test_base_spans_equal_the_patterns(spark, texts):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    crafted = ["secret: token = abcdefghijklmnop", "PASSWORD=\"abcdefghijkl\" api_key : x", "ſecret=abcdefghijklmnop", "token='a.b-c_d/e+f=g'",
               "AKIA" + "A" * 13, "xAKIAAKIA" + "9" * 14, "deadbeef" * 2 + "g" + "0" * 15, "apikey=secret=abcdefghijklmno"]
    for text in [*crafted, *(t for t in texts.values() if t)]:
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        got = [x for x in secrets.find_secrets(text) if x[0] != "entropy"]
        assert got == [(secrets.KINDS[k], s, e) for s, k, e in sorted(want)]


def test_entropy_windows_equal_recount():
    rng = random.Random(1)
    for letters in ("abcdef0123456789", "ABab01", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        for _ in range(60):
            run = "".join(rng.choices(letters, k=rng.randint(15, 60)))
            kind = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) else "alnum" if run.isalnum() else "base64"
            hits = []
            for i in range(len(run) - secrets.WINDOW + 1):
                counts = collections.Counter(run[i:i + secrets.WINDOW])
                bits = -sum(c / secrets.WINDOW * math.log2(c / secrets.WINDOW) for c in counts.values())
                if bits >= secrets.THRESHOLDS[kind] - 1e-12:
                    hits.append(i)
            assert secrets.entropy_span(run) == ((hits[0], hits[-1] + secrets.WINDOW) if hits else None)
    words = "some-long-path/with/words_and_names/in/it 123e4567-e89b-12d3-a456-426614174000 2024-01-02/03-04-05-06-07 thereforenevertheless"
    assert not [s for s in secrets.find_secrets(words) if s[0] == "entropy"]
    assert [s[0] for s in secrets.find_secrets("key Zx9Qw3Lk8Vb2Nm7Rt5Yp0Hs4 end")] == ["entropy"]


def test_random_tokens_are_found():
    rng = random.Random(6)
    token = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    entropy = lambda text: [(s, e) for k, s, e in secrets.find_secrets(text) if k == "entropy"]
    for n in (20, 24, 32, 40):
        assert sum(bool(entropy(f"key {token(n)} end")) for _ in range(2000)) >= 0.95 * 2000  # at 20 the threshold itself misses 3 %
    for word in ("example", "xxxx", "YOUR_KEY"):
        key = "Zx9Qw3Lk8Vb2Nm7Rt5Yp0Hs4"
        assert entropy(f"at {word}/{key} end") and entropy(f"at {key}/{word} end")
        assert any(s <= 4 + len(word) and e >= 3 + len(word) + len(key) for s, e in entropy(f"at {word}/{key}"))
    names = "chapter12section3paragraph14 release2024-version12-final3 your-api-key-example-xxxxxxxxxxxx example_placeholder_0123456789"
    assert not entropy(names)


# --- 7: quality rules --------------------------------------------------------------------

def test_measures_equal_brute_force(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality_rules"](spark, SMALL).collect()}
    assert len(rows) == len(texts)
    for i, text in texts.items():
        words = WORD.findall(text or "")
        windows = collections.Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        again = {j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(again))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(again) > 20 * len(words)) and not (r["base_failed"] and r["kept"])


def test_repeats_with_many_words():
    rng = np.random.default_rng(0)
    ids = rng.permutation(20_000)
    ids = np.concatenate([ids, ids[100:130], ids[50:54]])
    assert quality_rules.repeated_window_words(ids) == 60


def test_distance_equals_definition():
    p, q = np.array([[3.0, 1, 0, 6]]), np.array([1.0, 1, 4, 2])
    a, b = p[0] / 10, q / 8
    m = (a + b) / 2
    want = math.sqrt((sum(x * math.log2(x / y) for x, y in zip(a, m) if x) + sum(x * math.log2(x / y) for x, y in zip(b, m) if x)) / 2)
    assert abs(quality_rules.distance(p, q)[0] - want) < 1e-12


def test_clean_documents_are_kept(spark):
    sf = "/root/testdata/sf0.1"
    judged = quality_rules.quality_rules(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id")
    counts = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in judged.groupBy("quality", "base_failed", "kept").count().collect()}
    assert not counts.get((1, False, False)) and counts[(0, False, False)] > 50


def test_languages_of_the_corpus_have_references(spark):
    rng = random.Random(9)
    def text(letters, n=80):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)) + "."
    latin, cyrillic, greek = "abcdefghilmnoprstu", "абвгдежзийклмнопрст", "αβγδεζηθικλμνξοπρστ"
    english = quality_rules.LANGUAGES["en"].split()
    rows = [(i, " ".join(w for _ in range(60) for w in (rng.choice(english), text(latin, 1))), "en") for i in range(120)]
    rows += [(1000 + i, text(cyrillic), "ru") for i in range(120)] + [(2000 + i, text(greek), "el") for i in range(5)]
    rows += [(3000, "#$% &|< " * 5 + " ".join(f"{i}#$%&|{i * i}" for i in range(80)), "ru"), (3001, "one two", "el")]
    judged = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    kept = {r["doc_id"]: r["kept"] for r in judged}
    assert len(judged) == len(rows) and all(kept[i] for i in kept if i < 3000)
    assert not kept[3000] and not kept[3001]
    assert {r["doc_id"] // 1000 for r in judged if r["char_distance"] > 0} == {0, 1, 3}


# --- 9: factorisation machine ------------------------------------------------------------

def test_pair_sum_equals_identity():
    rng = np.random.default_rng(6)
    model = quality_fm.FactorisationMachine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    rows = [(rng.permutation(20)[:n], rng.normal(size=n)) for n in (3, 1, 7)]
    starts = np.array([0, 3, 4])
    got = model.raw(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts)
    for (i, v), g in zip(rows, got):
        pairs = sum(model.vectors[i[a]] @ model.vectors[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert abs(0.3 + model.weights[i] @ v + pairs - g) < 1e-9


def test_sample_is_not_lowered():
    assert quality_fm.SAMPLE == 6000


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op9_quality_fm"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    for r in rows[:200]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.98 * len(held)
    assert sum(r["predicted"] for r in held if not r["quality"]) <= 0.1 * sum(not r["quality"] for r in held)


# --- 10: shards --------------------------------------------------------------------------

def test_hot_group_is_cut_and_the_rest_kept_whole(spark):
    rows = [(i, "hot" * 10) for i in range(3000)] + [(3000 + i, f"text {i // 3} " + "x" * (i % 50)) for i in range(3000)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    sizes, counts = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
        counts[r["shard"]] += 1
    assert len(sizes) == 16 and max(sizes.values()) < 1.03 * min(sizes.values())
    for k in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(counts[k]))
    text = dict(rows)
    where = collections.defaultdict(set)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
    assert len(where.pop("hot" * 10)) > 5 and all(len(x) == 1 for x in where.values())


# --- queries with SQL, and the pipeline --------------------------------------------------

@pytest.mark.parametrize("name", ["op2_jaccard", "op7_quality_rules", "op8_url_filter", "op10_shards", "op11_divergence", "op12_cross_polytope", "op13_prefix_trie"])
def test_oracle(spark, name):
    from oracle_check import compare

    assert compare(spark, MEDIUM, [name], verbose=False)[name][0] == "ok"


def test_pipeline_equals_its_stages_by_brute_force(spark, texts):
    labels = table(spark, SMALL, "labels")
    docs = table(spark, SMALL, "documents")
    scores = quality_fm.score(docs, quality_fm.train(docs, labels), ["doc_id"]).collect()
    kept = {r["doc_id"]: texts[r["doc_id"]] for r in scores if r["score"] >= 0.7}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").encode().lower().split()) else set() for i, t in kept.items()}
    group = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if group[a] < group[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    group[b], changed = group[a], True
    left = {i: kept[i] for i in kept if group[i] == i}
    leaked = {r["doc_id"] for r in decontaminate.leaks(docs, table(spark, SMALL, "benchmark")).collect()}
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    want = {i: library.encode(secrets.redact(t, s) if (s := secrets.find_secrets(t)) else t or "", add_special_tokens=False).ids
            for i, t in left.items() if i not in leaked}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


# --- what must not grow with the square of a group -----------------------------------------

def test_near_copies_are_not_paired_one_by_one(spark):
    """2,000 copies with three words changed, few of which link: tokens meet blocks, not all pairs of sets."""
    rng = random.Random(1)
    words = [f"w{k}" for k in range(5000)]
    base = rng.choices(words, k=120)
    docs = []
    for k in range(2000):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(120)] = rng.choice(words)
        docs.append((k, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counted = jaccard.stored(jaccard.census(df, "doc_id", "text", 0), "test-census")
    classes = counted.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"))
    levels, hot = jaccard._levels(jaccard._sketch(counted.where("block IS NOT NULL").select("block", "counts")))
    tokens = jaccard.stored(jaccard.shared_tokens(df, "text", 0, levels, hot, 16), "test-tokens")
    placed = jaccard.stored(jaccard.blocks(tokens, classes), "test-placed")
    met = tokens.join(placed, "class").select("token", "block").distinct().groupBy("token").count()
    pairs = met.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert placed.count() == classes.count() and pairs <= 20_000
    assert jaccard.candidates(tokens, placed).count() <= 500


def test_random_letters_and_short_tokens_are_found():
    rng = random.Random(9)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def recall(letters, n):
        return sum(any(k == "entropy" for k, _, _ in secrets.find_secrets("key " + "".join(rng.choices(letters, k=n)) + " end")) for _ in range(1000)) / 1000

    for letters, sizes in ((low + up, (20, 24, 32, 40)), (up, (24, 32, 40)), (low + digits, (16, 17, 18, 19)), (up + digits, (16, 18)), (low + up + digits, (16, 18, 20))):
        for n in sizes:
            assert recall(letters, n) >= 0.9, (letters, n)
    assert recall(up, 20) >= 0.78  # the rest can be said like words
    clean = ("JavaScriptFrameworkDeveloper getConnectionByIdentifier some-long-path/with/words INTERNATIONALIZATION responsibilities "
             "Donaudampfschifffahrtsgesellschaft release2024-version12 well-established-practice chapter12section3 2024-01-02T03:04:05")
    assert not secrets.find_secrets(clean)


def test_seeds_cover_every_leak():
    """Any passage over the bars holds as many n-gram starts of the item as the seeds are chosen for."""
    rng = np.random.default_rng(7)
    tried = 0
    while tried < 300:
        n = int(rng.integers(2, 60))
        item = rng.integers(0, 40, n)
        text = [int(w) for w in item if rng.random() > 0.15]
        for _ in range(int(rng.integers(0, n))):
            text.insert(int(rng.integers(0, len(text) + 1)), int(rng.integers(0, 60)))
        text = np.array(text, np.int64)
        if not len(text) or not decontaminate.is_leak(*decontaminate.align(item, text)[:2], n) or n < decontaminate.WHOLE_WORDS:
            continue
        tried += 1
        held = {(int(text[a]), int(text[b])) for a in range(len(text)) for b in (a + 1, a + 2) if b < len(text)}
        starts = {a for a in range(n) for b in (a + 1, a + 2) if b < n and (int(item[a]), int(item[b])) in held}
        assert len(starts) >= decontaminate.least_starts(n)
