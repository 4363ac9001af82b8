"""Page filters and a tolerant article extractor on the standard parser, run in Arrow batches."""

from __future__ import annotations

import gzip
import re
import zlib
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_HTML, MAX_HTML, MIN_TEXT = 500, 5_000_000, 120
# Parts of urls, signs of pages without an article, and elements that are not part of one.
URL_PARTS = "/tag/ /tags/ /topic/ /topics/ /author/ /authors/ /search ?s= &s= /login /signin /signup /register /account /video/ /videos/ /gallery/ /galleries/ /slideshow/ /comments/".split()
NOISE = r"<title>\s*(?:login|sign in|search|tag:|author:)|captcha|access denied"
DROP_TAGS = frozenset("script style noscript template svg canvas iframe form button input select option footer nav aside".split())
DROP_CLASSES = frozenset("advert ads ad cookie cookies newsletter promo related recommended share social sidebar menu".split())
DROP_IDS = frozenset("advert ads cookie newsletter sidebar menu".split())
CONTAINER_CLASSES = frozenset("article article-body article-content post post-content entry-content story-body content".split())
DATE_KEYS = ("article:published_time", "article:modified_time", "og:updated_time", "pubdate", "publish-date", "date", "dc.date", "dc.date.issued")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("p div section article main li ul ol br h1 h2 h3 h4 h5 h6 tr table blockquote header body title figure figcaption time".split())


def before_decode(url: Column, size: Column, content_type: Column) -> Column:
    """Whether a response may hold an article, before its body is decoded."""
    low = F.lower(F.coalesce(url, F.lit("")))
    skip = F.exists(F.array(*[F.lit(x) for x in URL_PARTS]), lambda x: F.contains(low, x))
    return F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html")) & ~skip & size.between(MIN_HTML, MAX_HTML)


def after_decode(html: Column) -> Column:
    head = F.lower(F.substring(F.coalesce(html, F.lit("")), 1, 3000))
    return ~F.startswith(F.ltrim(head), F.lit("<?xml")) & ~head.rlike(NOISE)


def _brotli(raw: bytes) -> bytes:
    """Decompressed where a brotli module is installed; the bytes as they are where none is, or where they are none."""
    try:
        import brotli
    except ImportError:
        return raw
    try:
        return brotli.decompress(raw)
    except brotli.error:
        return raw


def decode_body(raw: bytes, encoding: str | None, content_type: str | None) -> str:
    """Decompressed if it can be, decoded by the declared charset, else UTF-8 or Latin-1, without control characters."""
    data = raw.replace(b"\0", b"") if not encoding else raw
    low = (encoding or "").lower()
    try:
        if "gzip" in low:
            data = gzip.decompress(raw)
        elif "deflate" in low:
            try:
                data = zlib.decompress(raw)
            except zlib.error:
                data = zlib.decompress(raw, -zlib.MAX_WBITS)
        elif "br" in low.split(",")[-1].split():
            data = _brotli(raw)
    except (OSError, zlib.error, EOFError):
        data = raw  # already decoded by whoever stored it
    declared = re.search(r"charset\s*=\s*[\"']?([\w.-]+)", content_type or "", re.I)
    for name in ([declared[1]] if declared else []) + ["utf-8"]:
        try:
            text = data.decode(name)
            break
        except (LookupError, UnicodeDecodeError):
            continue
    else:
        text = data.decode("latin-1")
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.title, self.h1, self.time, self.time_attr = [], [], [], ""
        self.stack: list[tuple[str, bool, int]] = []  # tag, dropped, container number or -1
        self.containers: list[list[str]] = []
        self.kinds: list[str] = []
        self.in_drop = 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            key = (a.get("property") or a.get("name") or "").lower()
            if key and a.get("content", "").strip():
                self.meta.setdefault(key, a["content"].strip())
            return
        classes = set(a.get("class", "").lower().split())
        if tag == "time" and a.get("datetime") and not self.time_attr:
            self.time_attr = a["datetime"]
        if tag in _VOID:
            if tag == "br":
                self._text("\n")
            return
        drop = tag in DROP_TAGS or bool(classes & DROP_CLASSES) or a.get("id", "").lower() in DROP_IDS
        number = -1
        if not drop and not self.in_drop and (tag in ("article", "main", "body") or a.get("role") == "main" or classes & CONTAINER_CLASSES):
            number = len(self.containers)
            self.containers.append([])
            self.kinds.append("body" if tag == "body" else "inner")
        self.stack.append((tag, drop, number))
        self.in_drop += drop
        if tag in _BLOCK:
            self._text("\n")

    def handle_endtag(self, tag):
        if tag not in [t for t, _, _ in self.stack]:
            return
        while self.stack:
            name, drop, _ = self.stack.pop()
            self.in_drop -= drop
            if name == tag:
                break
        if tag in _BLOCK:
            self._text("\n")

    def handle_data(self, data):
        tags = {t for t, _, _ in self.stack}
        if "title" in tags:
            self.title.append(data)
            return
        if "h1" in tags:
            self.h1.append(data)
        if "time" in tags:
            self.time.append(data)
        self._text(data)

    def _text(self, data):
        if not self.in_drop:
            for _, _, number in self.stack:
                if number >= 0:
                    self.containers[number].append(data)


def tidy(text: str) -> str:
    return "\n".join(s for x in re.split(r"\r\n?|\n", text) if (s := " ".join(x.split())))


def extract(url: str, html: str, stored: str = "", min_text: int = MIN_TEXT, prefer_inner: bool = True) -> dict:
    """Title, text, description, date, domain, image and the reason if there is no article.

    The longest container wins; with `prefer_inner` the longest one inside the body if it has enough text.
    """
    page = _Page()
    page.feed(html)
    page.close()
    texts = [(kind, tidy("".join(c))) for kind, c in zip(page.kinds, page.containers, strict=True)]
    inner = max((t for k, t in texts if k == "inner"), key=len, default="")
    text = inner if prefer_inner and len(inner) >= min_text else max((t for _, t in texts), key=len, default="")
    domain = re.sub(r"^www\.", "", urlsplit(url).netloc.lower())
    title = page.meta.get("og:title") or page.meta.get("twitter:title") or tidy("".join(page.title)) or tidy("".join(page.h1)) or domain
    date = next((page.meta[k] for k in DATE_KEYS if page.meta.get(k)), "") or page.time_attr or tidy("".join(page.time)) or stored
    wall = re.match(r"(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})", date)
    about = page.meta.get("og:description") or page.meta.get("description") or (text[:280] + "…" if len(text) > 280 else text)
    return {
        "url": url, "title": title.replace("\n", " "), "text": text if len(text) >= min_text else "", "description": about, "date": f"{wall[1]} {wall[2]}" if wall else "", "domain": domain,
        "image_url": page.meta.get("og:image", ""), "reason": "" if len(text) >= min_text else "short_text",
    }


EXTRACTED = "url string, title string, text string, description string, date string, domain string, image_url string, reason string"


def extract_pages(pages: DataFrame, min_text: int = MIN_TEXT, fallback=None) -> DataFrame:
    """Articles of pages (url, html, stored), with the page's `file` if it has one.

    `fallback(url, html)` may give the title and text of a page in which no article was found.
    """
    kept = ["file"] if "file" in pages.columns else []

    def one(url: str, page: str, stored: str) -> dict:
        found = extract(url, page, stored, min_text)
        if found["reason"] and fallback is not None and (other := fallback(url, page)) and len(other.get("text") or "") >= min_text:
            found |= {"title": other.get("title") or found["title"], "text": tidy(other["text"]), "reason": ""}
        return found

    def run(batches):
        for pdf in batches:
            out = pd.DataFrame([one(u or "", h or "", s or "") for u, h, s in zip(pdf["url"], pdf["html"], pdf["stored"], strict=True)], columns=[c.split()[0] for c in EXTRACTED.split(", ")])
            yield pd.concat([out, pdf[kept].reset_index(drop=True)], axis=1) if kept else out

    return pages.select("url", "html", "stored", *kept).mapInPandas(run, EXTRACTED + (", file string" if kept else ""))
