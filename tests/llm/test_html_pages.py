"""The whole extraction on made pages whose text is known, block by block."""

import html
import random
import re

import pytest

from gristmill.llm.html import PLAIN, extended, extract, label, learn, tokens

WORDS = "river stone light paper winter garden market letter window music copper forest & < café naïve 42".split()


class Maker:
    """Random pages: markup and the text that it shows."""

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def line(self, least, most, marks=True):
        """(markup, text) of words in one line, some of them in inline elements."""
        out, shown = [], []
        for n in range(self.rng.randint(least, most)):
            word = self.rng.choice(WORDS)
            mark = self.rng.choice(["b", "em", "i", "span", "code", "sup", "mark", "u"]) if marks and self.rng.random() < 0.2 else None
            raw = html.escape(word)
            glued = mark and n and self.rng.random() < 0.3  # the mark begins within a word
            out.append(("" if glued else " " if n else "") + (f"<{mark}>{raw}</{mark}>" if mark else raw))
            if glued:
                shown[-1] += word
            else:
                shown.append(word)
        return "".join(out), " ".join(shown)

    def block(self):
        kind, lines = self.rng.choice(["p", "p", "ul", "ol", "dl", "table", "pre", "blockquote", "h2", "h3", "figure", "section"]), []

        def made(least=1, most=9):
            raw, text = self.line(least, most)
            lines.append(text)
            return raw

        if kind in ("ul", "ol"):
            body = "".join(f"<li>{made()}" + ("</li>" if self.rng.random() < 0.7 else "") for _ in range(self.rng.randint(1, 9)))
        elif kind == "dl":
            body = "".join(f"<dt>{made(1, 2)}</dt><dd>{made()}</dd>" for _ in range(self.rng.randint(1, 4)))
        elif kind == "table":
            body = "".join("<tr>" + "".join(f"<td>{made(1, 3)}</td>" for _ in range(3)) + "</tr>\n" for _ in range(self.rng.randint(1, 4)))
        elif kind == "figure":
            body = f"<img src=x.png alt='not shown'><figcaption>{made()}</figcaption>"
        elif kind == "section":
            body = f"<h4>{made(1, 3)}</h4>\n<p>{made()}</p>"
        else:
            body = made()
        return f"<{kind}>{body}</{kind}>", " ".join(lines)

    def page(self, wrap):
        blocks = [self.block() for _ in range(self.rng.randint(1, 8))] + [(f"<p>{(x := self.line(30, 60))[0]}</p>", x[1])]
        self.rng.shuffle(blocks)
        menu = "".join(f"<li><a href='/{n}'>{self.line(1, 2, False)[0]}</a></li>" for n in range(self.rng.randint(3, 12)))
        gone = ["<script>var t = '<p>no</p>';</script>", "<!-- <p>no</p> -->", f"<div class='ad'>{self.line(3, 9)[0]}</div>", f"<aside><p>{self.line(3, 30)[0]}</p></aside>", f"<form><p>{self.line(2, 5)[0]}</p><input></form>"]
        raw = [b for b, _ in blocks]
        for piece in self.rng.sample(gone, 2):
            raw.insert(self.rng.randrange(len(raw) + 1), piece)
        body = wrap.format("\n".join(raw))
        head = f"<html><head><title>t</title><style>p {{}}</style></head><body><nav><ul>{menu}</ul></nav><header><p>{self.line(1, 5)[0]}</p></header>"
        return f"{head}{body}<div class='comments'><p>{self.line(5, 20)[0]}</p></div><footer><p>{self.line(2, 9)[0]}</p><ul>{menu}</ul></footer></body></html>", " ".join(t for _, t in blocks)


@pytest.fixture(scope="module")
def learned():
    made = Maker(1)
    return learn([[t[:2] for t in tokens(made.page("<article>{}</article>")[0])] for _ in range(60)])


@pytest.mark.parametrize("seed", range(2, 8))
def test_every_word_of_marked_articles(learned, seed):
    made = Maker(seed)
    for _ in range(50):
        page, text = made.page("<article>{}</article>")
        for weights in (learned, PLAIN):
            assert extract(page, weights) == text


def test_articles_without_their_mark(learned):
    made, found, want, both = Maker(11), 0, 0, 0
    for _ in range(200):
        page, text = made.page("{}")
        got = extract(page, learned).split()
        found, want = found + len(got), want + len(text.split())
        both += sum(min(got.count(w), text.split().count(w)) for w in set(got))
    assert both >= 0.99 * found and both >= 0.97 * want


def test_lists_and_leading_inline_words(learned):
    around = "<body><nav><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul></nav><article>{}</article></body>"
    many = "".join(f"<li>item {n} of the list</li>" for n in range(30))
    for weights in (learned, PLAIN):
        assert len(extract(around.format(f"<ol>{many}</ol>"), weights).split()) == 150
        assert extract(around.format("<p>one<b>two</b> three four five</p>"), weights) == "onetwo three four five"
        assert extract(around.format("<p><a href=z>Linked</a> words begin <a href=z>and end</a></p>"), weights) == "Linked words begin and end"


def test_extended_stops_at_blocks():
    items = [("p", 0), ("word a", 1), ("inline", 0), ("word", 3), ("/p", 0), ("word", 2), ("div", 0)]
    assert extended(items, 3, 4) == (1, 4) and extended(items, 5, 6) == (5, 6) and extended(items, 0, 0) == (0, 0)


def test_labels_are_found_whatever_is_in_them():
    page = Maker(4).page("<article>{}</article>")[0]
    items = [t[:2] for t in tokens(page)]
    lo, hi = label(items)
    assert items[lo - 1][0] == "article" and items[hi][0] == "/article" and len(re.findall("<article>", page)) == 1
