"""Main text by density: formula, thresholds and choice against a plain version, pages without any telling name, hostile pages."""

import math
import random
import re
import time

import pytest

from siteatlas.llm import density
from tests.conftest import SF


def neutral(html):
    """The page with elements that say what they are made plain, and without class, id and role."""
    html = re.sub(r"<(/?)(?:nav|article|footer|header|aside|main|section)\b", r"<\1div", html)
    return re.sub(r""" (?:class|id|role)=(?:"[^"]*"|'[^']*')""", "", html)


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet").select("html").collect()
    return [r.html for r in rows]


def test_density_finds_the_article_without_names(pages):
    right = lost = 0
    for html in pages:
        told, found = density.extract(html), density.extract(neutral(html))
        right += told == found
        lost += not set(told.split("\n")) <= set(found.split("\n"))
    assert right >= 0.96 * len(pages) and lost == 0


def test_a_flat_density_finds_something_else(pages, monkeypatch):
    told = [density.extract(neutral(html)) for html in pages]
    monkeypatch.setattr(density, "_density", lambda chars, *_: float(chars > 0))
    assert sum(density.extract(neutral(html)) != t for html, t in zip(pages, told, strict=True)) > 0.9 * len(pages)


class Plain:
    """The same by words of the module's text, recursively, on (tag, children) trees without names."""

    def __init__(self, tree):
        self.tree = tree
        chars, _, linked, _ = self.counts(tree)
        self.share = linked / max(chars, 1)

    def counts(self, node):
        """characters, tags below, characters in links, links below"""
        if isinstance(node, str):
            return len(re.sub(r"\s", "", node)), 0, 0, 0
        parts = [(c, self.counts(c)) for c in node[1]]
        chars = sum(p[0] for _, p in parts)
        tags = sum(p[1] + (not isinstance(c, str) and c[0] not in density.FORMAT) for c, p in parts)
        linked = chars if node[0] == "a" else sum(p[2] for _, p in parts)
        return chars, tags, linked, sum(p[3] + (not isinstance(c, str) and c[0] == "a") for c, p in parts)

    def formula(self, chars, tags, linked, links):
        if not chars:
            return 0
        t, ln, li = max(1, tags), max(1, links), max(1, linked)
        base = math.log(chars / max(1, chars - linked) * li + self.share * chars + math.e)
        return chars / t * max(0, math.log(chars / li * t / ln) / math.log(base))

    def density(self, node):
        return self.formula(*self.counts(node))

    def total(self, node):
        own = sum(self.counts(c)[0] for c in node[1] if isinstance(c, str))
        return self.formula(own, 0, 0, 0) + sum(self.density(c) for c in node[1] if not isinstance(c, str))

    def nodes(self, node):
        return [node] + [n for c in node[1] if not isinstance(c, str) for n in self.nodes(c)]

    def path(self, node, wanted):
        if node is wanted:
            return [node]
        for c in node[1]:
            if not isinstance(c, str) and (below := self.path(c, wanted)):
                return [node, *below]
        return []

    def content(self):
        best = max(self.nodes(self.tree), key=self.total)
        way = self.path(self.tree, best)
        counted = way if best is self.tree else way[1:]  # the tree's root is html, its child the body
        least, lowest = min(map(self.density, counted)), min(map(self.total, counted))
        chosen = [best]
        for node in self.nodes(self.tree):
            if not any(node is w for w in way) and not any(node is n for n in self.nodes(best)) and self.counts(node)[0] and self.density(node) >= least:
                top = max(self.nodes(node), key=self.total)
                if self.total(top) >= lowest:
                    chosen.append(top)
        return chosen

    def text(self):
        chosen, out = self.content(), []

        def walk(node, inside):
            inside = inside or any(node is c for c in chosen)
            for c in node[1]:
                if isinstance(c, str):
                    out.append(c if inside else "")
                else:
                    block = c[0] in density.BLOCK
                    out.append("\0" if block else "")
                    walk(c, inside)
                    out.append("\0" if block else "")

        walk(self.tree, False)
        return "\n".join(b for b in (re.sub(r"\s+", " ", x).strip() for x in "".join(out).split("\0")) if b)


def page(rng, depth=0):
    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n))

    if depth == 4 or rng.random() < 0.25:
        inner = [words(rng.randint(0, 40))]
        if rng.random() < 0.4:
            inner.append((rng.choice(["b", "a", "i", "span"]), [words(rng.randint(1, 6))]))
            inner.append(words(3))
        return rng.choice(["p", "h2", "li"]), inner
    return rng.choice(["div", "div", "ul", "blockquote"]), [page(rng, depth + 1) for _ in range(rng.randint(1, 5))]


def rendered(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(rendered, node[1]))}</{node[0]}>"


@pytest.mark.parametrize("seed", range(40))
def test_equals_the_plain_version(seed):
    rng = random.Random(seed)
    body = ("body", [page(rng, 1) for _ in range(rng.randint(1, 6))])
    assert density.extract(f"<html>{rendered(body)}</html>") == Plain(("html", [body])).text()


def test_an_article_in_parts_is_whole():
    part = "<div><p>" + "A paragraph with a number of words in it. " * 5 + "</p><p>" + "Another one of the same kind follows. " * 5 + "</p></div>"
    found = density.extract(f"<body><div><a href=x>Home</a><a href=y>News</a></div><div>{part}<div><a href=z>Share</a></div>{part}</div><div>Some line below.</div></body>")
    assert found.count("A paragraph") == 10 and found.count("Another") == 10
    assert "below" not in found and "Home" not in found  # what stands inside the chosen subtree stays


@pytest.mark.parametrize("html, text", [("<!--><p>Article</p>", "Article"), ("<!---><p>b</p>", "b"), ("<p>a</p><!-- x --!><p>b</p>", "a\nb"), ("<p>a<!-- b -- > --><p>c", "a\nc"), ("<p>a<!--", "a")])
def test_comment_ends(html, text):
    assert density.extract(html) == text


@pytest.mark.parametrize("html", ["<div>" * 20_000, "<b>" * 20_000 + "<p>" * 20_000, "<p><table>" + "<div>" * 20_000, "<li><div>" * 20_000, "</i>" * 20_000 + "<div>" * 20_000])
def test_unclosed_elements_take_time_in_proportion(html):
    start = time.thread_time()
    assert density.extract(html + "x") == "x"
    assert time.thread_time() - start < 4
