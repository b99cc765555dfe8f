"""HTML extraction: nothing of the article lost, nothing else let in, linear time."""

import random
import time
import tracemalloc
from html import escape

import pytest

from pluvial.llm import extract


def own(html):
    return extract.extract(html, None)


@pytest.mark.parametrize("icon", ["<svg class=i/>", "<svg class='i' />", "<svg><path d='M0'/><title>t</title></svg>",
                                  "<svg><svg/><g><svg><text>in</text></svg></g></svg>", "<!-->", "<!--->", "<!-- x -->",
                                  "<!-- x --!>", "<select><option>a<option>b</select>", "<object data=x>f</object>",
                                  "<style>p > a {}</style>", "<script>if (a<b) '</p>'</script x>", "<svg-icon></svg-icon>"])
def test_nothing_after_an_icon_is_lost(icon):
    page = f"<p>one two three{icon} four five</p>{icon}<p>six seven{icon}</p><p>eleven</p>"
    assert own(page) == "one two three four five six seven eleven"
    assert own(f"<article><h1>T</h1>{page}</article>") == "T one two three four five six seven eleven"


@pytest.mark.parametrize("left_open", ["<select><option>a<option>b", "<object data=x>f", "<svg><g>", "<svg><text>t"])
def test_open_elements_end_with_their_block(left_open):
    page = f"<div><p>first words here</p><div>{left_open}</div><p>second words</p><p>third</p></div>"
    assert own(page) == "first words here second words third"
    page = f"<article><p>first words here {left_open}</p><p>second words</p></article>"
    assert own(page) == "first words here second words"


def test_blocks_end_choices_and_drawings():
    assert own("<article><p>a few words</p><select><option>x<p>more of it</p></article>") == "a few words more of it"
    assert own("<article><p>a few words</p><svg><g><p>more of it</p></article>") == "a few words more of it"
    assert own("<article><p>a few words</p><svg><foreignObject><p>drawn</p></foreignObject></svg><p>end</p>") == "a few words end"


@pytest.mark.parametrize("aside", ["<span class='ad'>buy</span>", "<a class='share-button' href=x>Share this</a>",
                                   "<button>Subscribe</button>", "<label>Mail <input></label>", "<em id=newsletter>join</em>",
                                   "<span class='social'><b>f</b> <i>t</i></span>", "<font role='search'>find</font>"])
def test_inline_adverts_and_forms_stay_out(aside):
    page = f"<article><h1>Title</h1><p>x y{aside} z &am{aside}p; w</p>{aside}<p>end of it</p>{aside}</article>"
    assert own(page) == "Title x y z & w end of it"
    assert own(f"<p>x y{aside} z</p>{aside}<div>{aside}</div><p>w{aside}</p>") == "x y z w"


def test_names_of_place_do_not_mark_words():
    page = "<article><h1><span class='page-header'>Title</span></h1><p>a <b class='side'>bold</b> word</p></article>"
    assert own(page) == "Title a bold word"


def test_an_inline_wrapper_around_the_article_keeps_it():
    page = "<body><x-shell class='layout-header'><main><h1>T</h1><p>" + "word " * 50 + "</p></main></x-shell></body>"
    assert own(page) == " ".join(["T"] + ["word"] * 50)


class Reader:
    """Random pages with the text that must come out."""

    def __init__(self, seed):
        self.rng, self.n = random.Random(seed), 0

    def words(self, low, high):
        out = []
        for _ in range(self.rng.randint(low, high)):
            self.n += 1
            out.append(self.rng.choice(["w%d", "é%d", "a&b%d", "x<y%d", "日%d"]) % self.n)
        return out

    def noise(self):
        return self.rng.choice(["", "", "", "<!-- c -->", "<!-->", "<svg/>", "<script>x</script>",
                                "<span class='ad'>buy <b>now</b></span>", "<button>go</button>",
                                "<a class='share'>s</a>", "<img src=x>", "<svg><text>v</text></svg>"])

    def line(self, words):
        out = ""
        for w in words:
            safe = escape(w)
            out += " " * self.rng.randint(1, 3) + self.noise() + self.rng.choice(
                ["%s", "%s", "<b>%s</b>", "<a href='#'>%s</a>", "<span class=k><i>%s</i></span>"]) % safe
        return out + self.noise()

    def block(self):
        noise = self.rng.choice(["", "<div class='advert'><p>buy this</p></div>", "<form><label>q</label></form>",
                                 "<nav><ul><li>m</li></ul></nav>", "<aside>s</aside>", "<div class='cookie-notice'>c</div>"])
        words = self.words(8, 20)
        kind = self.rng.choice(["p", "p", "p", "h2", "ul", "pre"])
        if kind == "ul":
            cut = len(words) // 2
            return words, f"<ul><li>{self.line(words[:cut])}</li><li>{self.line(words[cut:])}</ul>{noise}"
        return words, f"<{kind}>{self.line(words)}</{kind}>{noise}"

    def page(self):
        title = self.words(2, 4)
        blocks = [self.block() for _ in range(self.rng.randint(3, 12))]
        body = "".join(b for _, b in blocks)
        html = (f"<html><head><title>t</title></head><body class='no-sidebar'><div class='site-header'><p>menu here</p></div>"
                f"<article><h1>{self.line(title)}</h1>{body}</article>"
                "<div class='comments'><p>nice nice nice</p></div><footer>f</footer>")
        return " ".join([*title, *(w for words, _ in blocks for w in words)]), html


def test_random_pages():
    for seed in range(300):
        want, html = Reader(seed).page()
        assert own(html) == want, html


def measured(html):
    tracemalloc.start()
    at = time.process_time()
    page = extract.read_page(html)
    path, _ = extract.best_container(page)
    text = extract.text_at(page, path)
    seconds, (_, peak) = time.process_time() - at, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    return text, seconds, peak


@pytest.mark.parametrize("deep", [
    "<div class='entry-content wide'>", "<div class='entry-content'><p>w ", "<b><i>w", "<ul><li>w", "<section><h1>w</h1>",
    "<blockquote>w ", "<p>w <b>", "<table><tr><td>w", "<header><h1>w</h1>", "<svg>", "<select><p>w", "<li>w<div></div><b>",
    "<div class='widget'><p>w</p>"])
def test_deep_pages_take_linear_time(deep):
    _, seconds, peak = measured(f"<body>{deep * 20_000}<p>last words</p>")
    # tracemalloc slows allocation about four times
    assert seconds < 16 and peak < 500e6
    html = f"<body>{deep * 20_000}<p>last words</p>"
    at = time.process_time()
    extract.extract(html, None)
    assert time.process_time() - at < 4


def test_long_pages_are_read_whole():
    parts = [f"word{i}" for i in range(200_000)]
    html = "<article>" + "".join(f"<p>{' '.join(parts[i:i + 50])}</p>" for i in range(0, len(parts), 50)) + "</article>"
    assert own(html) == " ".join(parts)


def test_paths_as_text_and_as_hashes_agree():
    html = "<body><div class='b12 a'><section class='x>y'><p>some words</p></section></div></body>"
    page = extract.read_page(html)
    for node in page.nodes:
        assert extract.path_key(extract.path_of(node)) == node.key
    assert extract.best_container(page)[0] == ">body>div.a.b#>section.x&gt;y"


def test_ties_go_to_the_first_container():
    html = "<body><section><p>same words</p></section><main><p>same words</p></main></body>"
    assert extract.best_container(extract.read_page(html))[0].endswith("body")
    html = "<section><div><p>same words</p></div></section><main><div><p>same words</p></div></main>"
    assert extract.best_container(extract.read_page(html))[0] == ">section>div"
