"""Repeated passages, license notices, benchmark items and page text, against plain versions."""

import hashlib
import html
import random
import re
from collections import Counter

import pytest

from tidemark.llm import decontamination, license_scan, line_blocks, phrase_automata
from tests.llm.data import COLUMNS, awkward, documents, words


# repeated passages


def without_repeats(rows, window=phrase_automata.WINDOW):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    starts = Counter(tuple(w[k : k + window]) for w in texts for k in range(len(w) - window + 1))
    result = []
    for (doc_id, _), w in zip(rows, texts):
        away = set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] > 1:
                away.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in away)
        result.append((doc_id, len(w), len(away), hashlib.sha256(kept.encode()).hexdigest()))
    return result


def by_text(rows):
    return sorted(rows, key=str)


def test_repeats_equal_the_plain_version(spark, monkeypatch):
    rng = random.Random(2)
    passages = [words(rng, n) for n in (34, 35, 36, 60, 200)]
    rows = [(i, t) for i, t, _ in awkward()]
    for k in range(120):
        text = []
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            text += words(rng, rng.randrange(50)) + passage[rng.randrange(20) if rng.random() < 0.4 else 0 :]
        rows.append((5000 + k, "  ".join(text)))
    rows += [(6000, "spam " * 200), (6001, "a b c " * 50), (6002, " ".join(["a b c"] * 11))]
    docs = documents(spark, rows).repartition(4)
    got = [tuple(r) for r in phrase_automata.digests(docs).collect()]
    assert by_text(got) == by_text(without_repeats(rows))


def test_repeats_across_small_chunks(spark, monkeypatch):
    """Passages whose copies lie in different shards are confirmed by their groups."""
    rng = random.Random(3)
    passage = words(rng, 80)
    rows = [(k, " ".join(words(rng, 30) + passage[k % 7 :] + words(rng, 30))) for k in range(12)]
    docs = documents(spark, rows).repartition(12)
    got = [tuple(r) for r in phrase_automata.digests(docs).collect()]
    assert by_text(got) == by_text(without_repeats(rows))
    assert all(r[2] >= 74 for r in got)


def test_repeats_of_nothing(spark):
    assert phrase_automata.digests(spark.createDataFrame([], COLUMNS)).collect() == []


# license notices


def base_places(text):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)
    places, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        found = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


NOTICES = [
    (1, "Released UNDER the MIT-License; under the mit license"),
    (2, "Apache License, Version 2.0 and CC BY-NC"),
    (3, "released undr the MIT licence today"),
    (4, "Apache Licence Version 2"),
    (5, "apache license version 3, under the limit license, cc by nd"),
    (6, "under the mit license" * 3),
    (7, "under the mit license under the mit license"),
    (8, "gnu general public license, version 3"),
    (9, "é underéthe mit license"),
]


def test_base_places_equal_the_plain_version(spark):
    rows = [(i, t) for i, t, _ in awkward()] + NOTICES
    got = license_scan.license_scan(documents(spark, rows)).collect()
    base = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert by_text(base) == by_text([(i, *base_places(t)) for i, t in rows])
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.score == 0) == (r.labels == "")
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_notices_with_errors(spark):
    got = {r.doc_id: r for r in license_scan.license_scan(documents(spark, NOTICES)).collect()}
    assert got[3].labels == "mit" and got[3].base_labels == "" and 0.8 < got[3].score < 1
    assert got[3].spans[0][1:] == (1, 4, 2)
    assert got[4].labels == "apache-2"
    assert got[5].labels == ""
    assert got[8].labels == "gpl-3" and got[8].score == 1


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_any_notice_within_its_errors_is_found():
    rng = random.Random(4)
    scanner = license_scan.Scanner()
    for _ in range(300):
        phrase, label, fixed = rng.choice(license_scan.NOTICES)
        one = license_scan.notice(phrase, label, fixed)
        letters = list(phrase)
        for _ in range(rng.randrange(one.errors + 1)):
            k = rng.randrange(1, len(letters) - 1)
            if letters[k].isalpha() and not any(f in "".join(letters[max(0, k - 7) : k + 7]) for f in fixed):
                letters[k] = rng.choice("qxz")
        broken = "".join(letters)
        result = scanner.scan(f"some words {broken} and more")
        assert label in result[5].split(","), (phrase, broken)
        assert result[6] >= 1 - edits(phrase, broken) / len(phrase) - 1e-9


# benchmark items


def best_distance(item, text):
    """Fewest word edits of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        old, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return min(row)


def test_items_equal_the_plain_version(spark):
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, rng.choice([3, 5, 8, 20, 70, 150])))) for k in range(30)]
    items += [(100, None), (101, ""), (102, items[4][1])]
    rows = [(i, t) for i, t, _ in awkward()]
    for k in range(120):
        w = rng.choice(items[:30])[1].split()
        for _ in range(rng.randrange(12)):
            at, r = rng.randrange(len(w)), rng.random()
            if r < 0.4:
                w[at] = "changed"
            elif r < 0.7 and len(w) > 1:
                del w[at]
            else:
                w.insert(at, "more")
        rows.append((7000 + k, ", ".join([*words(rng, 15), *w, *words(rng, 15)]).upper()))
    docs = documents(spark, rows)
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, lang string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminations(docs, table).collect()}
    want = {}
    for doc_id, text in rows:
        w = decontamination.words_of(text or "")
        for item_id, item in items:
            p = decontamination.words_of(item or "")
            if sum(map(len, p)) >= decontamination.LEAST_BYTES:
                d = best_distance(p, w)
                if d <= int(len(p) * decontamination.TOLERANCE):
                    want[doc_id, item_id] = d
    assert {k: r.distance for k, r in got.items()} == want and len(want) > 40
    for (doc_id, item_id), r in got.items():
        part = decontamination.words_of(dict(rows)[doc_id])[r.first_word : r.last_word + 1]
        assert edits(part, decontamination.words_of(dict(items)[item_id])) == r.distance
    clean = decontamination.drop_contaminated(docs, table)
    assert clean.columns == docs.columns
    assert clean.count() == len(rows) - len({d for d, _ in want})


def test_short_items_and_scripts_without_blanks(spark):
    """One to four words stand as they are; an ideograph is a word; too little text is no evidence."""
    chinese = "数据处理引擎能够在大型集群上运行并且完成所有查询"
    items = [(1, "Constantinople"), (2, "blue whale sings"), (3, "a b c"), (4, "four little words here"), (5, chinese)]
    items += [(6, "ภาษาไทยไม่มีช่องว่าง"), (7, "短い文"), (8, "数据处理")]
    table = spark.createDataFrame(items, "item_id long, text string")
    edited = chinese.replace("大型", "很大") + "了"
    rows = [
        (1, "once in Constantinople, they"), (2, "The BLUE whale -- sings!"), (3, "blue whale never sings"), (4, "a b c"),
        (5, "xfour little words here"), (6, "so, four little words here."), (7, f"他说{chinese}。"), (8, f"他说，{edited}"),
        (9, chinese[:12] + "没有" + chinese[20:]), (10, "ก ภาษาไทยไม่มีช่องว่าง ข"), (11, "数据"), (12, "Constantinoples"),
    ]
    docs = documents(spark, rows)
    want = set()
    for doc_id, text in rows:
        w = decontamination.words_of(text)
        for item_id, item in items:
            p = decontamination.words_of(item)
            if len("".join(p)) >= 12 and best_distance(p, w) <= int(len(p) * decontamination.TOLERANCE):
                want.add((doc_id, item_id))
    assert want == {(1, 1), (2, 2), (6, 4), (7, 5), (8, 5), (7, 8), (8, 8), (9, 8), (10, 6)}
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, table).collect()} == want
    kept = {r.doc_id for r in decontamination.drop_contaminated(docs, table).collect()}
    assert kept == {3, 4, 5, 11, 12}


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 60)
    items = [(k, f"item number {k} has these words") for k in range(9)]
    docs = documents(spark, [(k, f"before item number {k} has these words after") for k in range(12)])
    table = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontamination.blocks(table))) > 2
    got = decontamination.contaminations(docs, table).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(k, k) for k in range(9)]
    assert sorted(r.doc_id for r in decontamination.drop_contaminated(docs, table).collect()) == [9, 10, 11]


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, "some words of a document")])
    assert decontamination.contaminations(docs, none).collect() == []
    assert decontamination.drop_contaminated(docs, none).count() == 1
    empty = spark.createDataFrame([], COLUMNS)
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.contaminations(empty, one).collect() == []
    assert license_scan.license_scan(empty).collect() == []


# page text


def article_of(page):
    inner = re.search(r"(?s)<article>(.*)</article>", page).group(1)
    blocks = [re.sub(r"<[^>]+>", "", re.sub("<br>", " ", b)) for b in re.split(r"</?(?:p|h\d)>", inner)]
    return "\n\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))


def test_every_page_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in line_blocks.extract_pages(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article_of(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


LONG = "a long line of running text that says something and then goes on " * 3


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><script>var a = '<p>x</p>'</script><style>p{}</style></html>", ""),
        ("only &lt;text&gt; &amp; nothing&nbsp;else", "only <text> & nothing else"),
        (f"<div class='top menu'><a href=x>Home</a></div><div><p>{LONG}<p>Short.</div>", LONG.strip() + "\n\nShort."),
        (f"<article><h1>T</h1><p>One <b>two</b>\n three<br>four</p></article><p>{LONG}</p>", "T\n\nOne two three four"),
        (f"<main><p>Kept.</p><section id='comments'><p>{LONG}</p></section><p>Too.</p></main>", "Kept.\n\nToo."),
        (f"<aside><p>{LONG}</p></aside><p>{LONG}</p><form>{LONG}</form><footer>{LONG}</footer>", LONG.strip()),
        (f"<div><span class='ad'>Buy!</span><p>{LONG}</p></div>", LONG.strip()),
        (f"<!-- <p>x</p> --><p title='a > b'>{LONG}</p", LONG.strip() + " </p"),
        (f"<ul><li>{LONG}<li>b</ul>", LONG.strip() + "\n\nb"),
        ("<p>brief</p>", "brief"),
    ],
)
def test_page(page, text):
    assert line_blocks.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><ul><li><a href=y>One</a><li><a href=z>Two</a></ul></article>",
         f"Title\n\n{LONG.strip()}\n\nOne\n\nTwo"),
        (f"<main><p>Lead.</p><p><a href=x>{LONG}</a></p><p>End.</p></main>", f"Lead.\n\n{LONG.strip()}\n\nEnd."),
        ("<article><h1><a href=x>Only a link</a></h1></article>", "Only a link"),
        (f"<article><a name=top><p>{LONG}</p><p>Short.</p></article>", LONG.strip() + "\n\nShort."),
        (f"<article><a href=x><p>{LONG}</p><p>Short.</p></article>", LONG.strip() + "\n\nShort."),
        (f"<div><a name=top><p>{LONG}</p></a><a href=x><p>{LONG}</p></div>", LONG.strip() + "\n\n" + LONG.strip()),
        (f"<div><p><a href=x>Home</a> <a href=y>News</a></p><p>{LONG}</p></div>", LONG.strip()),
    ],
)
def test_page_with_links(page, text):
    assert line_blocks.main_text(page) == text


@pytest.mark.parametrize(
    "name",
    "content with-sidebar|has-sidebar|has-left-sidebar|post comments-open|no-comments|social-science|legal-news"
    "|article-header|page widget|main-menu-page".split("|"),
)
@pytest.mark.parametrize("inner", ["div", "article", "main"])
def test_wrappers_named_like_surroundings(name, inner):
    page = (
        f"<div class='menu'>Home</div><div class='{name}'><{inner}><h1>Title</h1><p>{LONG}</p><p>End.</p></{inner}>"
        f"<div id='comments' class='comments-area'><p>{LONG * 2}</p></div></div><div class='site-footer'>Imprint</div>"
    )
    assert line_blocks.main_text(page) == f"Title\n\n{LONG.strip()}\n\nEnd."


@pytest.mark.parametrize(
    "name", "top-menu|site-header|sidebar|widget ad-slot|social-links|legal-notice|search-form|share|related-posts|menu menu-open".split("|")
)
def test_surroundings_by_name(name):
    page = f"<main><p>{LONG}</p><div class='{name}'><p>Not this.</p><article>Nor this.</article></div><p>End.</p></main>"
    assert line_blocks.main_text(page) == f"{LONG.strip()}\n\nEnd."
    assert line_blocks.main_text(page.replace("main>", "div>").replace("article>", "b>")).startswith(LONG.strip())
    assert "this" not in line_blocks.main_text(page.replace("main>", "div>").replace("article>", "b>"))


@pytest.mark.parametrize(
    "between", ["<div class=ad>Buy this!</div>", "<p class=notice>Read this.</p>", "<p><a href=x>More of this</a></p>"]
)
def test_weak_lines_beside_the_text(between):
    """Without article or main, whatever separates them from it; links in the span stay."""
    link = ["More of this"] if "href" in between else []
    parts = ["<h1>Title</h1>", "<p>Short lead.</p>", f"<p>{LONG}</p>", "<p>Weak.</p>", f"<p>{LONG}</p>", "<p>The end.</p>"]
    texts = ["Title", "Short lead.", LONG.strip(), "Weak.", LONG.strip(), "The end."]
    want = [texts[0], *(t for text in texts[1:] for t in [*link, text])]
    body = between.join(parts)
    for page in (body, f"<div>{body}</div>", f"<div><div><p>Else</p></div>{between}</div><div>{body}</div>"):
        assert line_blocks.main_text(page) == "\n\n".join(want)
    assert line_blocks.main_text(f"<p>One.</p>{between}<p>Two longer.</p>") == "\n\n".join(["One.", *link, "Two longer."])


def test_a_linked_headline_before_the_text():
    page = f"<p><a href=x>Home</a></p><div><h1><a href=x>Title</a></h1><p>{LONG}</p></div><p><a href=y>Next</a></p>"
    assert line_blocks.main_text(page) == f"Title\n\n{LONG.strip()}"


def test_pages_with_nulls(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a</p>", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = line_blocks.extract_pages(pages).collect()
    assert by_text([tuple(r) for r in got]) == by_text([(1, "u", "", 0), (None, None, "a", 1), (2, "u", "", 0)])
