import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webcapture.functions.html_events import scan_batch
from webcapture.functions.selectors import (
    DEFAULT_EXCLUDES,
    compile_selectors,
    parse_selectors,
    resolve_exclude_list,
    resolve_excludes,
    selectors_error,
)


def kept(html, exclude=(), include=()):
    events = scan_batch(pa.array([html]), compile_selectors(exclude), compile_selectors(include), with_raw=True)
    return "".join(e["raw"] for e in events[0].as_py() if e["keep"])


def element_for(selector):
    """An element that the selector must match, and one that it must not."""
    m = re.fullmatch(r'(\w*)\[(\w+)([*^$])="(.*)"\]', selector)
    if m:
        tag, name, op, value = m.groups()
        tag = tag or "div"
        hit = {"*": f"x{value}y", "^": f"{value}y", "$": f"x{value}"}[op]
        miss = {"*": value[:-1], "^": f"x{value}", "$": f"{value} z"}[op]
        return tag, f'{name}="{hit}"', f'{name}="{miss}"'
    if selector[0] == ".":
        return "div", f'class="a {selector[1:]} b"', f'class="{selector[1:]}s"'
    if selector[0] == "#":
        return "div", f'id="{selector[1:]}"', f'id="{selector[1:]}s"'
    return selector, "", None


@pytest.mark.parametrize("selector", DEFAULT_EXCLUDES)
def test_each_built_in_form(selector):
    tag, hit, miss = element_for(selector)
    void = tag in ("input", "img")
    body = "" if void else f"gone</{tag}>"
    html = f"<p>a</p><{tag} {hit}>{body}<p>b</p>"
    assert kept(html, [selector]) == "<p>a</p><p>b</p>"
    if miss is not None:
        html = f"<p>a</p><{tag} {miss}>{body}"
        assert kept(html, [selector]) == html


def test_sixty_built_ins_in_order():
    assert len(DEFAULT_EXCLUDES) == len(set(DEFAULT_EXCLUDES)) == 60
    assert DEFAULT_EXCLUDES[0] == "script" and DEFAULT_EXCLUDES[-1] == '[class*="_offset_"]'


PAGE = (
    '<main><article class="post big" id="x"><h1>t</h1><p lang="en-GB">one <b>two</b></p>'
    '<div data-id="7,8"><p>deep</p></div></article></main><article><p>other</p></article>'
)


@pytest.mark.parametrize(
    "selector,want",
    [
        ("main article p", '<p lang="en-GB">one <b>two</b></p><p>deep</p>'),
        ("main > article > p", '<p lang="en-GB">one <b>two</b></p>'),
        ("main>article.post>div", '<div data-id="7,8"><p>deep</p></div>'),
        ("main > p", ""),
        ("article.post.big h1, b", "<h1>t</h1><b>two</b>"),
        ("article:has(h1, h2) > h1", None),
        ("article:has(h2)", ""),
        ("main:has(div p)", None),
        ("article:not(.post)", None),
        ('[data-id="7,8"]', '<div data-id="7,8"><p>deep</p></div>'),
        ("[data-id]", '<div data-id="7,8"><p>deep</p></div>'),
        ("[lang|=en]", '<p lang="en-GB">one <b>two</b></p>'),
        ("[class~='big'] > *", '<h1>t</h1><p lang="en-GB">one <b>two</b></p><div data-id="7,8"><p>deep</p></div>'),
        ("ARTICLE#x b", "<b>two</b>"),
        ('[class^=""]', ""),
        ("p:hover", None),
        ("p + p", None),
        ("", None),
    ],
)
def test_grammar(selector, want):
    if want is None:
        with pytest.raises(ValueError):
            compile_selectors([selector])
    else:
        assert kept(PAGE, include=[selector]) == want


@pytest.mark.parametrize(
    "selector,want",
    [
        ("section div > p b", "<b>1</b><b>2</b>"),
        ("section > div p > b", "<b>1</b><b>2</b>"),
        ("div div > p > b", "<b>2</b>"),
        ("div > div > p b", "<b>2</b>"),
        ("section div div div b", ""),
        ("section section b", ""),
    ],
)
def test_chains_look_at_every_ancestor(selector, want):
    html = "<section><div><p><b>1</b></p><i><div><p><b>2</b></p></div></i></div></section>"
    html = html if selector != "div > div > p b" else html.replace("<i>", "").replace("</i>", "")
    assert kept(html, include=[selector]) == want


def test_long_chains_stay_linear():
    html = "<div>" * 500 + "<p><b>x</b></p>" * 20000
    assert kept(html, include=["section div div div div > p b"]) == ""
    assert kept(html, include=["div div div div > p b"]).count("<b>") == 20000


def test_has_keeps_subject_with_match():
    got = kept(PAGE, include=["article:has(h1, h2)"])
    assert got.startswith('<article class="post big"') and got.endswith("</article>") and "other" not in got
    assert kept(PAGE, exclude=["article:has(h1)"]) == "<main></main><article><p>other</p></article>"


def test_include_nested_once_and_exclude_inside():
    assert kept(PAGE, include=["article", "p", "b"], exclude=["b", "#x > div"]) == (
        '<article class="post big" id="x"><h1>t</h1><p lang="en-GB">one </p></article><article><p>other</p></article>'
    )


def test_parse_selectors(column):
    cases = [
        (" .a, #b ,,.a, nav ", [".a", "#b", "nav"], False),
        ('["main article", " .a ", "", null, ".a", "x[y=\\"z,w\\"]"]', ["main article", ".a", 'x[y="z,w"]'], False),
        ("[]", [], False),
        ("  ", None, False),
        (None, None, False),
        ("[bad", None, True),
        ('["a", 1]', None, True),
        ('["a"] x', None, True),
    ]
    values = [c[0] for c in cases]
    assert column(values, parse_selectors("c")) == [c[1] for c in cases]
    assert [e is not None for e in column(values, selectors_error("c"))] == [c[2] for c in cases]


def test_resolve(column):
    user = F.array(F.lit("nav"), F.lit(" .x "), F.lit(""), F.col("c"))
    got = column([".x", None], resolve_excludes(user))
    assert got == [[*DEFAULT_EXCLUDES, ".x"]] * 2
    assert column([".y"], resolve_excludes(user, empty_tags=True)) == [["nav", ".x", ".y"]]
    assert resolve_exclude_list(["nav", " .x", 5, ""]) == [*DEFAULT_EXCLUDES, ".x"]
    assert resolve_exclude_list(None, empty_tags=True) == []
