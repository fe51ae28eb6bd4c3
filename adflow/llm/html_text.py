"""Main text of web pages: leaf blocks, labelled by a bidirectional LSTM in numpy.

A page is cut into leaf blocks: runs of text between block-level tags. Each block has its
tag path (with class and id words) and its words, both hashed to vectors. The network
reads all blocks of a page in both directions and labels each as main text or not.

It learns on a bounded sample of pages. Their blocks are labelled by what their tag paths
say; copies of these pages with other wrappers, many of which say nothing, and with added
menus, notices, forms, sidebars and comments teach it to read other markup as well.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.text import Texts, slices

SAMPLE = 300  # pages the network learns on, at most
COPIES = 8
HIDDEN = 16
PATH_PLACES = 256
LEAF_PLACES = 16
WORD_PLACES = 32
WIDTH = PATH_PLACES + LEAF_PLACES + WORD_PLACES + 4
BATCH_BYTES = 1 << 20

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins del kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr "
    # Formulas are part of the sentence around them.
    "math annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo mover "
    "mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtext "
    "mtr munder munderover semantics".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# What these hold is not text of the page. The first two and comments end with the page at the
# latest; of the others a start tag without an end tag is passed over alone.
RAW = frozenset("template noscript svg iframe object canvas noembed noframes".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"""
    r"|<[!?/][^>]*>", re.S | re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in [*RAW, "xmp"]}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
# Opening one of these closes an open one of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BLOCK_IN_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split())

ASIDE_TAGS = frozenset(
    "nav footer aside form head title menu dialog button select textarea label header option "
    "legend".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer discussion disqus footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices pagination pager popup promo related "
    "reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "tags toolbar topbar widget".split())
MAIN_TAGS = frozenset(["article", "main"])
MAIN_NAMES = frozenset("article body content entry main post story text".split())

Block = tuple[tuple[str, ...], str, int]


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order: tag path, text, characters inside links."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked, anchors = 0, 0
    at = 0
    endless: set[str] = set()

    def end_of(tag: str) -> re.Match | None:
        found = None if tag in endless else _ENDS[tag].search(page, at)
        if not found:
            endless.add(tag)
        return found

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((tuple(n for _, names in stack for n in names.split()), text, linked))
        parts.clear()
        linked = 0

    while m := _TAG.search(page, at):
        if m.start() > at:
            parts.append(page[at:m.start()])
            if anchors:
                linked += m.start() - at
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        tag = name.lower()
        if m[2] or m[5]:
            if tag in INLINE:
                anchors = max(anchors - (tag == "a"), 0)
                continue
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            close()
            if depth is not None:
                del stack[depth:]
            anchors = 0
        elif tag in RAW:
            end = None if tag == "svg" and m[0].endswith("/>") else end_of(tag)
            at = end.end() if end else at
        elif tag == "xmp" and (end := end_of(tag)):
            close()  # an old name of pre, with all it holds as text
            stack.append(("pre", "pre"))
            parts.append(html.escape(page[at:end.start()]))
            close()
            stack.pop()
            at = end.end()
        elif tag in ("br", "mtd"):
            parts.append(" ")
        elif tag in INLINE:
            anchors += tag == "a"
        elif tag not in VOID:
            close()
            shut = CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK_IN_P else set())
            if shut:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in shut:
                        del stack[k:]
                        break
                    if stack[k][0] not in ("p", "dl", "span"):
                        break
            names = [tag]
            for found in _NAMES.findall(m[4] or m[7] or ""):
                names += [f".{w}" for w in _PART.findall("".join(found).lower())]
            stack.append((tag, " ".join(names)))
        elif tag == "hr":
            close()
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def told(page: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks their tag paths put inside a main container, and which beside the text."""
    main = [any(n in MAIN_TAGS or n[1:] in MAIN_NAMES and n[0] == "." for n in path)
            for path, _, _ in page]
    aside = [any(n in ASIDE_TAGS or n[1:] in ASIDE_NAMES and n[0] == "." for n in path)
             for path, _, _ in page]
    return np.array(main, bool), np.array(aside, bool)


def teach(page: list[Block]) -> np.ndarray:
    """Labels from tag paths: inside a main container, not inside anything beside it. On a
    page without a container, text outside of what is beside it that is mostly no links."""
    main, aside = told(page)
    if (main & ~aside).any():
        return (main & ~aside).astype(np.float64)
    return np.array([not a and 2 * linked < len(text)
                     for a, (_, text, linked) in zip(aside, page)], np.float64)


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    if path not in _paths:
        if len(_paths) > 50_000:
            _paths.clear()
        out = np.zeros(PATH_PLACES + LEAF_PLACES, np.float32)
        for name in path:
            code = zlib.crc32(name.encode())
            out[code % PATH_PLACES] = 1
        tags = [n for n in path if n[0] != "."]
        if tags:
            out[PATH_PLACES + zlib.crc32(tags[-1].encode()) % LEAF_PLACES] = 1
        _paths[path] = out
    return _paths[path]


def features(pages: list[list[Block]]) -> np.ndarray:
    """A row per block, all pages end to end."""
    flat = [b for p in pages for b in p]
    out = np.zeros((len(flat), WIDTH), np.float32)
    if not flat:
        return out
    texts = Texts.of(pa.array([t for _, t, _ in flat], pa.string()), lower=True)
    words = texts.words()
    bag = np.bincount(words.rows() * WORD_PLACES
                      + (words.hashes() % np.uint64(WORD_PLACES)).astype(np.int64),
                      minlength=len(flat) * WORD_PLACES).reshape(-1, WORD_PLACES)
    out[:, :PATH_PLACES + LEAF_PLACES] = [_path_vector(p) for p, _, _ in flat]
    at = PATH_PLACES + LEAF_PLACES
    out[:, at:at + WORD_PLACES] = bag / np.maximum(words.counts, 1)[:, None]
    size = np.array([len(t) for _, t, _ in flat])
    out[:, -4] = np.log1p(size) / 8
    out[:, -3] = np.minimum(np.array([n for _, _, n in flat]) / np.maximum(size, 1), 1)
    mark = np.isin(texts.data, np.frombuffer(b".,;:!?", np.uint8))
    out[:, -2] = np.minimum(texts.sums(mark) / np.maximum(size, 1) * 10, 1)
    out[:, -1] = np.concatenate([np.arange(len(p)) / max(len(p), 1) for p in pages])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BiLstm:
    """Weights per direction: input and state to the four gates, bias; then the output."""

    params: list[np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> BiLstm:
        out = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1
            out += [rng.standard_normal((WIDTH, 4 * HIDDEN)) * np.sqrt(1 / 12),
                    rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN), bias]
        return cls([*out, rng.standard_normal(2 * HIDDEN) / np.sqrt(2 * HIDDEN), np.zeros(1)])

    def _run(self, x: np.ndarray, live: np.ndarray, side: int, trace: list | None):
        """States of one direction; x is (step, page, feature), live marks real blocks."""
        w, u, b = self.params[3 * side:3 * side + 3]
        gates = x @ w + b
        steps, n = x.shape[:2]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out = np.zeros((steps, n, HIDDEN))
        for t in (range(steps) if side == 0 else range(steps - 1, -1, -1)):
            g = gates[t] + h @ u
            i, f, o = (_sigmoid(g[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            z = np.tanh(g[:, 3 * HIDDEN:])
            new = f * c + i * z
            squashed = np.tanh(new)
            on = live[t][:, None]
            if trace is not None:
                trace.append((t, h, c, i, f, o, z, squashed))
            h, c = np.where(on, o * squashed, h), np.where(on, new, c)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, live, k, None) for k in (0, 1)], axis=2)
        return both @ self.params[6] + self.params[7][0]

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        traces: list[list] = [[], []]
        states = [self._run(x, live, k, traces[k]) for k in (0, 1)]
        both = np.concatenate(states, axis=2)
        d = (_sigmoid(both @ self.params[6] + self.params[7][0]) - y) * live / live.sum()
        out: list[np.ndarray] = []
        for side in (0, 1):
            w, u, _ = self.params[3 * side:3 * side + 3]
            top = d[:, :, None] * self.params[6][side * HIDDEN:(side + 1) * HIDDEN]
            gw, gu, gb = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN)
            dh, dc = np.zeros(states[side][0].shape), np.zeros(states[side][0].shape)
            for t, h, c, i, f, o, z, squashed in reversed(traces[side]):
                on = live[t][:, None]
                dh = dh + top[t]
                own = np.where(on, dh, 0)
                cell = np.where(on, dc, 0) + own * o * (1 - squashed ** 2)
                gate = np.concatenate([cell * z * i * (1 - i), cell * c * f * (1 - f),
                                       own * squashed * o * (1 - o), cell * i * (1 - z ** 2)],
                                      axis=1)
                gw += x[t].T @ gate
                gu += h.T @ gate
                gb += gate.sum(axis=0)
                dh = np.where(on, gate @ u.T, dh)
                dc = np.where(on, cell * f, dc)
            out += [gw, gu, gb]
        return [*out, np.einsum("tn,tnk->k", d, both), np.array([d.sum()])]


def _padded(rows: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(lengths)
    x = np.zeros((steps, len(lengths), rows.shape[1]), np.float32)
    live = np.zeros((steps, len(lengths)), bool)
    at = 0
    for k, n in enumerate(lengths):
        x[:n, k] = rows[at:at + n]
        live[:n, k] = True
        at += n
    return x, live


# Wrappers for copies of sample pages, as (tag, names); beside the main text, and of it.
_BESIDE = [("nav",), ("header",), ("footer",), ("aside",), ("form",), ("div", ".menu"),
           ("div", ".nav"), ("div", ".header"), ("div", ".footer"), ("div", ".sidebar"),
           ("div", ".cookie", ".notice"), ("div", ".notice"), ("div", ".ad"),
           ("div", ".advert"), ("div", ".banner"), ("section", ".comments"),
           ("div", ".comments"), ("div", ".comment"), ("ul", ".menu"), ("div", ".related"),
           ("div", ".share"), ("div", ".newsletter"), ("section", ".sidebar")]
# Tags that hold main text, plain or with names.
_HOLDERS = ["div", "section", "div", "td", "article", "main"]


def _word(rng: np.random.Generator) -> str:
    """A name that says nothing."""
    return "." + "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(2, 8)))


def _named(rng: np.random.Generator, tag: str, telling: list[str]) -> tuple[str, ...]:
    """A tag with a telling name among others, as class lists and ids have them."""
    names = [f".{telling[rng.integers(len(telling))]}"] + [_word(rng) for _ in range(rng.integers(0, 3))]
    return (tag, *[names[k] for k in rng.permutation(len(names))])


def _main_wrap(rng: np.random.Generator) -> tuple[str, ...]:
    """What main text is in: a telling tag, a tag with telling names, or one that says nothing."""
    tag = _HOLDERS[rng.integers(len(_HOLDERS))]
    kind = rng.random()
    if kind < 0.25:
        return [("article",), ("main",), ("main", "article")][rng.integers(3)]
    if kind < 0.7:
        return _named(rng, tag, sorted(MAIN_NAMES))
    return (tag, _word(rng)) if kind < 0.85 else ("div",) if kind < 0.95 else ()


def _beside_wrap(rng: np.random.Generator) -> tuple[str, ...]:
    if rng.random() < 0.5:
        return _BESIDE[rng.integers(len(_BESIDE))]
    return _named(rng, ["div", "section", "ul", "aside"][rng.integers(4)], sorted(ASIDE_NAMES))


# Leaves that main text may have besides paragraphs, headings and lists.
_LEAVES = [("figure", "figcaption"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"),
           ("table", "tr", "th"), ("table", "tbody", "tr", "td"), ("dl", "dt"), ("dl", "dd"), ("h5",),
           ("h6",), ("section", "p"), ("section", "h2"), ("div",), ("div", "p"), ("ol", "li"), ("ul", "li"),
           ("ul", "li", "p"), ("details", "summary"), ("details", "p"), ()]


def vary(page: list[Block], labels: np.ndarray, rng: np.random.Generator):
    """A copy of a page with other wrappers and added blocks beside the main text."""
    words = " ".join(t for _, t, _ in page).split() or ["-"]

    def extra(inside: tuple) -> list[tuple[Block, float]]:
        wrap = _beside_wrap(rng)
        leaf = [("p",), ("ul", "li"), (), ("div",), ("h2",)][rng.integers(5)]
        out = []
        for _ in range(rng.integers(1, 6)):
            start = rng.integers(len(words))
            text = " ".join(words[start:start + rng.integers(1, 40)])
            linked = len(text) if "li" in leaf and rng.random() < 0.7 else 0
            out.append(((("html", "body") + inside + wrap + leaf, text, linked), 0.0))
        return out

    main = _main_wrap(rng)
    out: list[tuple[Block, float]] = []
    for _ in range(rng.integers(0, 4)):
        out += extra(())
    seen = False
    for (path, text, linked), y in zip(page, labels):
        if y:
            leaf = tuple(n for n in path if n in ("p", "h1", "h2", "h3", "h4", "li", "ul", "ol"))
            if rng.random() < 0.2:
                leaf = _LEAVES[rng.integers(len(_LEAVES))]
            if rng.random() < 0.15:  # main text may be short, too
                text = " ".join(text.split()[:rng.integers(1, 7)])
                linked = min(linked, len(text))
            if seen and rng.random() < 0.08:
                out += extra(main if rng.random() < 0.5 else ())
            out.append(((("html", "body") + main + leaf, text, linked), 1.0))
            seen = True
        elif rng.random() < 0.7:
            out.append(((path, text, linked), 0.0))
    for _ in range(rng.integers(0, 4)):
        out += extra(())
    return [b for b, _ in out], np.array([y for _, y in out])


def fit(pages: list[str], epochs: int = 24, batch: int = 24, rate: float = 0.01) -> BiLstm | None:
    """Train on pages and ``COPIES`` varied copies of each, with Adam; None without a block."""
    rng = np.random.default_rng(13)
    net = BiLstm.fresh(rng)
    data = []
    for page in pages:
        own = blocks(page)
        if own:
            y = teach(own)
            data.append((own, y))
            data += [v for v in (vary(own, y, rng) for _ in range(COPIES)) if v[0]]
    if not data:
        return None
    data = [(features([p]), y) for p, y in data]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params]
    step = 0
    for epoch in range(epochs):
        order = sorted(rng.permutation(len(data)), key=lambda k: len(data[k][1]) // 8)
        groups = [order[k:k + batch] for k in range(0, len(order), batch)]
        for k in rng.permutation(len(groups)):
            own = [data[i] for i in groups[k]]
            x, live = _padded(np.concatenate([f for f, _ in own]), [len(y) for _, y in own])
            y = np.zeros(live.shape)
            y.T[live.T] = np.concatenate([y for _, y in own])
            step += 1
            slow = rate * (1 - epoch / epochs) + rate / 20
            for p, g, (m, v) in zip(net.params, net.gradients(x, live, y), moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= slow * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def main_texts(net: BiLstm | None, pages: list[str]) -> list[str]:
    """The main blocks' texts per page. Tag paths that tell are followed, as for the labels that the
    network learns from; it decides about all other blocks. Where no block is left, or there is
    no network, the rule of the labels is used, so an article is never lost whole."""
    found = [blocks(p) for p in pages]
    if net is None:
        return [" ".join(t for (_, t, _), y in zip(p, teach(p)) if y) for p in found]
    x = features(found)
    at = np.concatenate([[0], np.cumsum([len(p) for p in found])])
    keep = np.zeros(len(x), bool)
    full = sorted((k for k in range(len(found)) if found[k]), key=lambda k: len(found[k]))
    k = 0
    while k < len(full):
        # Pages of like length run together; a long page runs alone.
        most = max(1, min(256, 20_000 // len(found[full[min(k + 255, len(full) - 1)]])))
        own = full[k:k + most]
        k += most
        rows, live = _padded(np.concatenate([x[at[i]:at[i + 1]] for i in own]),
                             [len(found[i]) for i in own])
        keep[np.concatenate([np.arange(at[i], at[i + 1]) for i in own])] = (
            net.logits(rows, live) > 0).T[live.T]
    return [" ".join(t for (_, t, _), y in zip(p, _decided(p, keep[a:b])) if y)
            for p, a, b in zip(found, at, at[1:])]


def _decided(page: list[Block], keep: np.ndarray) -> np.ndarray:
    """Tag paths that tell are followed; the network decides about all other blocks."""
    main, aside = told(page)
    keep = (keep | main) & ~aside
    return keep if keep.any() else teach(page)


def train(pages: DataFrame, key: str = "page_id", page: str = "html",
          most: int = SAMPLE) -> BiLstm | None:
    """Fit on the first ``most`` pages in hash order of their key; pages without a key, null and
    empty ones do not count. None without a page to learn from."""
    every = pages.select(F.col(key).alias("k"), F.col(page).alias("page")).where(
        F.col("k").isNotNull() & (F.length("page") > 0))
    picked = every.select("k").orderBy(F.xxhash64("k"), "k").limit(most)
    rows = every.join(F.broadcast(picked.distinct()), "k").distinct().toLocalIterator()
    return fit([r["page"] for r in sorted(rows, key=lambda r: (str(r["k"]), r["page"]))][:most])


def extract(pages: DataFrame, net: BiLstm | None, keep: list[str], page: str = "html") -> DataFrame:
    """``keep`` columns and the main ``text``.

    A null or empty page, or one without a main block, has empty text. A page whose blocks the
    network all refuses, and every page where there is no network, is read by its tag paths.
    Repeated rows are treated alike; pages are read whole, whatever their length. A block whose
    score is a tie (0) is not main text. An empty table gives no rows. Only ``keep`` and the page
    are read, so other columns may have any name.
    """
    picked = pages.select(*keep, F.col(page).alias("__page"))

    def run(batches):
        for batch in slices(batches, "__page", BATCH_BYTES):
            found = main_texts(net, pc.fill_null(batch.column("__page"), "").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(found, pa.string())],
                names=[*keep, "text"])

    types = dict(picked.dtypes)
    return picked.mapInArrow(run, ", ".join(
        [f"`{k}` {types[k]}" for k in keep] + ["text string"]))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Pages are read whole, however long; a null or empty page has the empty text. Repeated rows
    each get a row. Other columns are not read, whatever they are called. An empty table gives
    no row.
    """
    return extract(pages, train(pages), ["page_id", "url"]).withColumn(
        "n_chars", F.length("text").cast("long"))
