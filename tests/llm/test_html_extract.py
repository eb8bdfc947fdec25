"""Main text of generated pages against their parts, and of hostile markup."""
import random
import time

import pytest

from panelcast.llm import html_extract as H

TREE = H.train()


def _words(rng, n):
    return " ".join(rng.choice(["river", "stone", "valley", "of", "the", "north", "wind"]) for _ in range(n))


@pytest.mark.parametrize("seed", range(60))
def test_generated_pages_with_and_without_containers(seed):
    """The paragraphs and headings that a page was made of, in order, whatever stands around them."""
    rng = random.Random(seed)
    links = lambda k: "<ul>" + "".join(f'<li><a href="/{i}">{_words(rng, rng.randint(1, 2))}</a></li>' for i in range(k)) + "</ul>"
    text = [f"{_words(rng, rng.randint(10, 120))}." for _ in range(rng.randint(1, 5))]
    body = "".join(f"<p>{t}</p>" for t in text)
    if rng.random() < 0.5:
        text.insert(0, _words(rng, 4))
        body = f"<h1>{text[0]}</h1>{body}"
    if rng.random() < 0.7:
        body = rng.choice(["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', "<div><div>{}</div></div>"]).format(body)
    around = ["<nav>{}</nav>".format(links(5)), links(4), "<header><p>{}</p></header>".format(_words(rng, 20)), '<script>var p = "<p>no</p>";</script>']
    after = ["<footer><p>{}</p></footer>".format(_words(rng, 30)), links(6), '<div class="comments"><p>{}</p></div>'.format(_words(rng, 40)),
             '<aside><p>{}</p></aside>'.format(_words(rng, 25))]
    page = "<html><body>" + "".join(rng.sample(around, rng.randint(0, 4))) + body + "".join(rng.sample(after, rng.randint(0, 4))) + "</body></html>"
    assert H.main_text(page, TREE).split("\n\n") == text


def test_tree_uses_links_where_no_container_is_known():
    def used(t):
        return {H.FEATURES[t[0]]} | used(t[2]) | used(t[3]) if isinstance(t, tuple) else set()
    assert {"zone", "words", "density", "density_after"} <= used(TREE)
    assert all(H.classify(TREE, r[:-1]) == r[-1] for r in H.LABELLED)
    rng = random.Random(1)
    near = lambda: (rng.choice([0, 1, 3, 9, 20, 60, 500]), rng.choice([0.0, 0.2, 0.5, 0.8, 1.0]))
    for _ in range(20_000):
        row = (*near(), *near(), *near())
        assert H.classify(TREE, (1, *row)) == 1 and H.classify(TREE, (-1, *row)) == 0
        if row[0] >= 20 and row[1] <= 0.2:
            assert H.classify(TREE, (0, *row)) == 1


@pytest.mark.parametrize("piece", ['<p x="', "<a '", "<p ", "<div>", "</i", "<p a='\"", "<!x", "<p \"'", "&amp", "<!--", "<", "<div aaaa", "<script>"])
def test_hostile_markup_takes_linear_time(piece):
    started = time.process_time()
    H.main_text(piece * (1_000_000 // len(piece)) + "</section>" * 1_000 + "\">", TREE)
    H.main_text("<div " + "a" * 1_000_000 + ">x", TREE)
    assert time.process_time() - started < 20          # the pattern took minutes for a tenth of this


def test_scanner_keeps_text_of_what_is_no_tag():
    texts = lambda page: [b.text for b in H.blocks(page)]
    assert texts("a < b and <3 > 2") == ["a < b and <3 > 2"]
    assert texts('<p title="x > y">one</p><p>two') == ["one", "two"]
    assert texts("<p a='>one<p>two") == ["<p a='>one", "two"]
    assert texts("<script><!--</script>one<!-- no <p>--> two") == ["one two"]
    assert texts("<div><p>one</section></div>two") == ["one", "two"]
    assert texts("") == [] and H.main_text(None, TREE) == ""
