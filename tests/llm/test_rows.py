"""Operators that judge each text alone, next to plain Python."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sondelake.llm import langid, pii, repetition, secret_scan, token_counts, url_filter
from sondelake.llm.queries import QUERIES, prepare

SF_DIR = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
# Null, empty, blank only, repeated rows and ids, null id, very long, no letters.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (4, "drei vier"), (None, "no id here"),
    (5, "word " * 60_000), (6, "x" * 300_000), (7, "123 456 !!"), (8, "a\n\nb\na\n a\n"), (9, "日本 ñandú Ünï"),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    rows = [(i, t, "en" if i and i % 2 else None, "kept", 7) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, n_words long")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def plain_pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def plain_secrets(text):
    assign = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def test_pii_query(spark, texts):
    found = by_id(QUERIES["op1_pii"](spark, SF_DIR))
    assert found.keys() == texts.keys()
    for key, text in texts.items():
        base = plain_pii(text)
        assert found[key].base_sha256 == digest(base)
        kinds = Counter(k for k, *_ in base)
        assert [found[key][f"n_{k}"] for k in pii.BASE_KINDS] == [kinds[k] for k in pii.BASE_KINDS]
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(found[key].spans.split(","))


def test_pii_patterns_on_noise():
    draw = random.Random(3)
    for alphabet in ("a1.@-+ ()25%_é", "1234567890  -."):
        for _ in range(3000):
            text = "".join(draw.choices(alphabet, k=draw.randint(0, 50)))
            assert pii.base_spans(text) == plain_pii(text)
    assert pii.base_spans("1" * 5000 + ".1.1.1") == []


def test_field_finds_names_and_numbers():
    field = pii.Field(pii.labelled_table())
    right = total = 0
    for tokens, labels in pii.labelled_table(seed=5, rows=200):
        encoded = pii._encode([" ".join(tokens)])
        got = [pii.LABELS[k] for k in field.decode(pii.features(*encoded), encoded[3])]
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.95
    text = "Please call Dr. Maria Weber, SSN: 123-45-6789 today"
    assert [text[a:b] for _, a, b in pii.spans(field, [text])[0]] == ["Maria Weber", "123-45-6789"]
    # A stretch is decoded as it would be alone, wherever it stands in a long text.
    long = "under the stone " * 200 + text + " the river" * 300
    assert [long[a:b] for _, a, b in pii.spans(field, [long])[0]] == ["Maria Weber", "123-45-6789"]


def test_secrets_query(spark, texts):
    found = by_id(QUERIES["op2_secrets"](spark, SF_DIR))
    for key, text in texts.items():
        base = plain_secrets(text)
        assert found[key].base_sha256 == digest(base)
        assert (found[key].n_assign, found[key].n_access, found[key].n_hex) == tuple(
            sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex")
        )


def test_secret_models(spark):
    model = secret_scan.MarkovRatio(secret_scan.labelled_samples())
    held = secret_scan.labelled_samples(seed=99, rows=300)
    right = sum((model.score(text) > secret_scan.THRESHOLD) == bool(label) for text, label in held)
    assert right / len(held) > 0.95
    text = "Token = abc12345 und passwords: x, AKIA" + "A1" * 8 + " ſecret=1234567 key a8F3kQ9zLx0Pq7Rt2Wv5 end"
    found = secret_scan.spans(text, model)
    assert [s for s in found if s[0] != "random"] == plain_secrets(text)
    assert [text[a:b] for k, a, b in found if k == "random"] == ["a8F3kQ9zLx0Pq7Rt2Wv5"]
    masked = secret_scan.masked(text, found)
    assert "abc12345" not in masked and "a8F3" not in masked and masked.startswith("[SECRET] und")
    docs = spark.createDataFrame([(1, text, len(text), "e"), (2, None, None, "f")], "doc_id long, text string, n_chars long, x string")
    rows = by_id(secret_scan.without_secrets(docs))
    assert rows[1].text == masked and rows[1].n_chars == len(masked) and rows[2].text is None and rows[2].x == "f"


def test_maximal_stretches_are_the_best_of_what_is_left():
    def plain(gains, at, end):
        sums = [(-sum(gains[i:j]), j - i, i, j) for i in range(at, end) for j in range(i + 1, end + 1)]
        if not sums or min(sums)[0] >= 0:
            return []
        _, _, i, j = min(sums)
        return [*plain(gains, at, i), (i, j), *plain(gains, j, end)]

    draw = random.Random(3)
    for size in (0, 1, 5, 12, 30) * 8:
        gains = np.array([draw.choice((-5, -3, -1, 2, 4, 7)) + draw.random() for _ in range(size)])
        assert secret_scan.maximal_stretches(gains) == plain(gains.tolist(), 0, size)


def test_secrets_within_mixed_runs():
    model = secret_scan.MarkovRatio(secret_scan.labelled_samples())
    draw = random.Random(11)
    letters = secret_scan._ALPHABET[:52]
    lost = 0
    for _ in range(40):
        key = "".join(draw.choices(letters + "0123456789", k=40))
        bare = "".join(draw.choices(letters, k=32))
        short = "".join(draw.choices(letters + "0123456789", k=20))
        text = f"AKIA{'AB12' * 4}/{key} at /api/v1/management/information/{short}/content/list?x /{bare}, user/account/manager/{short}"
        found = secret_scan.spans(text, model)
        assert [s for s in found if s[0] != "random"] == plain_secrets(text)
        masked = secret_scan.masked(text, found)
        lost += sum(part in masked for part in (key, bare, short))
        assert "management" in masked or "information" in masked
    assert lost <= 4
    for plain in ("x" * 300, "=" * 40, "12-34_" * 8, "/api/management/information/content/list", "getUserAccountInformationManager"):
        assert secret_scan.spans(plain, model) == []


def test_language_query(spark, texts):
    labels = by_id(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"))
    found = by_id(QUERIES["op3_language"](spark, SF_DIR))
    held = [k for k in texts if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k, r in found.items() if r.held_out} == set(held)
    judged = [k for k in held if any(map(str.isalpha, texts[k]))]
    assert np.mean([found[k].lang_pred == labels[k].lang for k in judged]) > 0.9
    assert all(0 <= r.score <= 1 for r in found.values())


def test_cross_parsing_counts_longest_matches():
    samples = {"a": ["abracadabra cadabra"], "b": ["xylophone zebra"]}
    model = langid.build(samples)
    text = "abracazebra"
    phrases, letters = langid.parse(model, [text, "", "!!"])
    for row, name in enumerate(model.languages):
        sample, at, count = samples[name][0], 0, 0
        while at < len(text):
            size = 1
            while at + size <= len(text) and text[at : at + size] in sample:
                size += 1
            at += max(1, size - 1)
            count += at < len(text)
        assert phrases[0, row] == count
    assert letters.tolist() == [11, 0, 0]


def test_whole_texts_are_parsed():
    """Phrases go on across stretches: counts are those of one pass over the whole text."""
    draw = random.Random(6)
    for letters in ("ab", "abcdefg"):
        samples = {name: ["".join(draw.choices(letters, k=900))] for name in ("x", "y")}
        samples["z"] = [letters * 400]  # very long matches
        sizes = (1, langid.STRETCH - 1, langid.STRETCH, langid.STRETCH + 1, 6000)
        texts = ["".join(draw.choices(letters + other, k=k)) for k in sizes for other in ("", "q")]
        texts += [letters * 500, samples["x"][0] * 3]
        model = langid.build(samples)
        phrases, _ = langid.parse(model, texts)
        for text, found in zip(texts, phrases.tolist()):
            for name, count in zip(model.languages, found):
                sample, at, plain = samples[name][0], 0, 0
                while at < len(text):
                    size = 1
                    while at + size <= len(text) and text[at : at + size] in sample:
                        size += 1
                    unknown = text[at] not in sample
                    at += max(1, size - 1)
                    plain += unknown or at < len(text)
                assert count == plain


#: Code points of the letters of ten scripts.
SCRIPTS = {
    "ar": [(0x627, 0x63B), (0x641, 0x64B)], "el": [(0x3B1, 0x3CA)], "en": [(0x61, 0x7B)], "he": [(0x5D0, 0x5EB)], "hi": [(0x905, 0x93A)],
    "ja": [(0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0x4F00)], "ko": [(0xAC00, 0xB400)], "ru": [(0x430, 0x450)], "th": [(0xE01, 0xE31)], "zh": [(0x4E00, 0x5600)],
}


def script_texts(name, rows, size=300):
    draw = random.Random(name)
    letters = [chr(code) for part in SCRIPTS[name] for code in range(*part) if chr(code).isalpha()]
    lexicon = ["".join(draw.choices(letters, k=draw.randint(1, 5))) for _ in range(400)]
    return [" ".join(draw.choices(lexicon, k=size // 4)) for _ in range(rows)]


def test_language_of_many_scripts():
    texts = {name: script_texts(name, 48) for name in SCRIPTS}
    model = langid.build({name: some[:40] for name, some in texts.items()})
    letters = {c for some in texts.values() for text in some[:40] for c in text if c.isalpha()}
    assert len({model.symbols[ord(c)] for c in letters}) == len(letters) > 1000
    for name, some in texts.items():
        assert langid.predict(model, some[40:])[0] == [name] * 8
    # A letter of no sample is a phrase of its own everywhere.
    assert langid.parse(model, ["\u10d0" * 5])[0].tolist() == [[5] * len(SCRIPTS)]


def test_language_samples_are_shared_evenly():
    assert langid._shares(np.array([5, 100, 0, 100]), 60).tolist() == [5, 27, 0, 28]
    # Each text has words of its own; one language or forty, all of them are in the sample.
    draw = random.Random(8)
    own = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(64)]
    samples = {f"l{k:02}": [f"{word} " * 150 for word in own] for k in range(40)}
    for some in ({"l00": samples["l00"]}, samples):
        model = langid.build(some)
        assert langid.parse(model, own)[0].tolist() == [[0] * len(some)] * 64
        assert np.allclose(model.bits, np.log2(langid.SAMPLE_SYMBOLS + 1))


def test_sparse_transitions_are_the_automaton():
    for name in ("en", "zh"):
        text = np.unique(np.array([ord(c) for c in script_texts(name, 1)[0]]), return_inverse=True)[1]
        table = langid._automaton(text)
        order = {int(symbol): k for k, symbol in enumerate(table.letters)}
        edges = langid.suffix_automaton([order[int(symbol)] for symbol in text])
        for state, out in enumerate(edges):
            cells = table.cells[table.base[state] + np.arange(len(order) + 1)].view(np.int32)
            assert {k: int(cells[2 * k]) for k in range(len(order) + 1) if cells[2 * k + 1] == state} == out


def test_repetition_query(spark, texts):
    found = by_id(QUERIES["op7_repetition"](spark, SF_DIR))
    for key, text in texts.items():
        row, tokens = found[key], BLANK.findall(text)
        grams = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
        counts = Counter(grams)
        hit = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if BLANK.search(line)]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(tokens), sum(map(len, tokens)), len(hit))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(tokens) < 50 or 100 * len(hit) > 50 * len(tokens))
        assert not (row.base_failed and row.kept)


def test_repetition_coverage():
    line = " ".join(f"w{k}" for k in range(20))
    found = repetition.measure(pa.array([f"{line}\n{line}", line, None]))
    size = len(line.replace(" ", ""))
    assert found["dup_chars_10"].tolist() == [2 * size, 0, 0] and found["dup_line_chars"].tolist() == [size, 0, 0]


def test_token_query(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = by_id(QUERIES["op9_token_counts"](spark, SF_DIR))
    for key, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (found[key].n_tokens, found[key].n_bytes, found[key].over_limit) == (n, len(text.encode()), n > 2048)


def test_token_transducer_on_odd_texts():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    spec = json.load(open(path))
    counter = token_counts.TokenCounter(spec, token_counts.character_classes(spec))
    draw = random.Random(4)
    odd = [
        "Don't you've 'she ''s 'll'd <|endoftext|>x<|startoftext|>", "İ ΑΣ ΑΣΑ e\u0301 é 日本 ١٢ ½ \u00a0x\u3000y", "", "'", "it's'S",
        *("".join(draw.choices("ab 'srevtm1!é日\n<|", k=draw.randint(0, 200))) for _ in range(300)),
    ]
    assert counter.count(odd).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in odd]


def test_url_query(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    extra = [(-1, None), (-2, "no scheme"), (-3, "HTTP://A.EXAMPLE.COM/de/x?q#f"), (-4, "x://sub.net/EN?a://b/c"), (-5, "x://notnet/a"),
             (-6, "http://net"), (-7, "http://cheap-pills.org/a"), (None, "http://x.org/fr/")]
    urls = [(r.page_id, r.url) for r in pages] + extra
    frame = spark.createDataFrame([(i, u, "h") for i, u in urls], "page_id long, url string, host string")
    found = {r.page_id: r for r in url_filter.judge(frame).collect()}
    assert len(found) == len(urls)
    for key, url in urls:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [(h + p, says) for says, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, key=lambda f: len(f[0]), default=(None, None))
        row = found[key]
        assert (row.host, row.path, row.rule) == (host, path, best[0])
        assert best[1] in (None, row.verdict)
    assert found[-7].verdict == "block" and found[-1].verdict == "allow"
    assert {r.page_id for r in QUERIES["op10_urls"](spark, SF_DIR).collect()} == {r.page_id for r in pages}


def test_words_of_hosts():
    segmenter = url_filter.Segmenter()
    assert segmenter.tokens("www.bestcasinobonus.com", "/freemoney/1") == ["www", "best", "casino", "bonus", "free", "money"]
    model = url_filter.NaiveBayes(segmenter)
    assert model.score(["casino", "bonus"]) > 0.5 > model.score(["science", "school"])


@pytest.mark.parametrize("operator", [pii.find, secret_scan.scan, langid.identify, repetition.repetition_rules])
def test_odd_rows(spark, odd, operator):
    rows = operator(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert operator(odd.limit(0)).collect() == []
    first = next(r for r in rows if r.doc_id == 1)
    if operator is langid.identify:
        assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 7)} == {"und"} and first.score == 0
    if operator is repetition.repetition_rules:
        assert first.n_words == 0 and first.base_failed


def test_odd_rows_of_tokens(spark, odd):
    pytest.importorskip("tokenizers")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = token_counts.token_counts(odd, path, 2048).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in rows if r.doc_id in (1, 2)} == {(0, 0, False)}
    assert next(r for r in rows if r.doc_id == 5).over_limit
    assert token_counts.token_counts(odd.limit(0), path, 2048).collect() == []


def test_odd_urls(spark):
    urls = [(1, None), (1, None), (2, ""), (2, "://"), (3, "http://" + "casino" * 3000 + ".com/" + "x" * 20_000), (None, "a://b")]
    pages = spark.createDataFrame([(i, u, "v", 2) for i, u in urls], "page_id long, url string, verdict string, score int")
    rows = url_filter.judge(pages).collect()
    assert Counter(r.page_id for r in rows) == Counter(i for i, _ in urls)
    assert all(r.verdict == "allow" and r.rule is None for r in rows if r.page_id in (1, 2))
    assert next(r.verdict for r in rows if r.page_id == 3) == "block"
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_language_without_labels(spark, odd):
    rows = langid.identify(odd.drop("lang").selectExpr("*", "cast(null as string) as lang")).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)} and len(rows) == len(ODD)
