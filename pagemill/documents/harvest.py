"""Links and images of a document tree."""

from __future__ import annotations

import re
from dataclasses import astuple, dataclass

from pagemill.documents.address import image_target, link_target, path_of, resolve
from pagemill.documents.dom import Node, one_line, parse, trim

# List limits; lazy-loading attributes in their order; extensions of images that links lead to; names of pages' preview images.
MAX_LINKS, MAX_IMAGES = 5000, 2000
LAZY = ("data-src", "data-original", "data-lazy-src", "data-url")
BACKGROUNDS = ("data-bg", "data-background", "data-background-image")
IMAGE_ENDS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".svg", ".avif")
PREVIEW_PROPERTIES = ("og:image", "og:image:url", "og:image:secure_url")
PREVIEW_NAMES = ("twitter:image", "twitter:image:src")


_MAY_BE_IMAGE = re.compile(r"\.(?:jpe?g|png|gif|webp|bmp|svg|avif)|%", re.I)
#: What markup must hold somewhere for a document to name any image.
_NAMES_IMAGES = re.compile(r"<img|<source|<noscript|image|data-b|" + _MAY_BE_IMAGE.pattern, re.I)


def may_have_images(markup: str) -> bool:
    return _NAMES_IMAGES.search(markup) is not None


@dataclass(slots=True)
class Image:
    id: int
    url: str
    alt: str = ""
    caption: str = ""
    width: str = ""
    height: str = ""
    source_page: str = ""

    def as_row(self) -> dict:
        return dict(zip(self.__slots__, astuple(self)))

    @property
    def placeholder(self) -> str:
        return f"[image:{self.id}: {self.alt}]" if self.alt else f"[image:{self.id}]"


def links(root: Node, base: str, limit: int = MAX_LINKS) -> list[tuple[str, str]]:
    """(address, text) of the links of the whole document in order, each address once with its first text."""
    found: dict[str, str] = {}
    for a in root.all("a"):
        url = link_target(a.get("href"), base)
        if url and url not in found:
            found[url] = one_line(a.words())
            if len(found) >= limit:
                break
    return list(found.items())


def first_of_set(srcset: str) -> str:
    """The first address of a srcset: what stands before the first comma, without its descriptor."""
    words = one_line(srcset.split(",", 1)[0]).split(" ")
    return words[0]


def bare_css_url(value: str) -> str:
    value = trim(value)
    if value.lower().startswith("url(") and value.endswith(")"):
        return trim(value[4:-1]).strip("'\"")
    return value


def image_url(img: Node, base: str) -> str:
    """An image's address: its src unless that is missing or inline data, then lazy-loading attributes, then sets of sources.

    Inline data without a lazy-loading attribute hides the sets of sources.
    """
    src = trim(img.get("src"))
    if not src or src.lower().startswith("data:"):
        lazy = (trim(img.get(k)) for k in LAZY)
        src = next((v for v in lazy if v and not v.lower().startswith("data:")), src)
    return image_target(src or first_of_set(img.get("srcset")) or first_of_set(img.get("data-srcset")), base)


def _described(img: Node, base: str, number: int, url: str) -> Image:
    figure = img.up("figure", 4)
    caption = next(figure.all("figcaption"), None) if figure else None
    link = img.up("a", 3)
    href = trim(link.get("href")) if link else ""
    leads = bool(href) and not href.startswith("#") and not href.lower().startswith("data:")
    return Image(number, url, trim(img.get("alt")), one_line(caption.words()) if caption else "", trim(img.get("width")), trim(img.get("height")), resolve(href, base) if leads else "")


def mark_images(root: Node, base: str, mark, limit: int = MAX_IMAGES) -> list[Image]:
    """The images below ``root`` in order, each address once; their nodes are replaced by the text ``mark(id)``.

    Images beyond the limit, and those without an address, stay as they are.
    """
    found: dict[str, Image] = {}
    for img in list(root.all("img")):
        url = image_url(img, base)
        if not url:
            continue
        if url not in found:
            if len(found) >= limit:
                continue
            found[url] = _described(img, base, len(found) + 1, url)
        img.replace(Node(None, text=mark(found[url].id)))
    return list(found.values())


def _previews(root: Node, base: str):
    for n in root.all("meta", "link"):
        if n.tag == "meta":
            if n.get("property").strip().lower() in PREVIEW_PROPERTIES or n.get("name").strip().lower() in PREVIEW_NAMES:
                yield image_target(n.get("content"), base)
        elif "image_src" in n.get("rel").lower():
            yield image_target(n.get("href"), base)


def all_images(root: Node, base: str, limit: int = MAX_IMAGES) -> list[Image]:
    """Every image that the document names: preview images first, then in order images, sources, links to images, what stands in noscript, backgrounds."""
    found: dict[str, Image] = {}

    def add(url: str, image: Image | None = None) -> None:
        if url and url not in found and len(found) < limit:
            found[url] = image or Image(0, url)
            found[url].id = len(found)

    for url in _previews(root, base):
        add(url)
    stack = [root]
    while stack:
        n = stack.pop()
        below = n.children
        if n.tag == "img":
            url = image_url(n, base)
            if url and url not in found:
                add(url, _described(n, base, 0, url))
        elif n.tag == "source":
            add(image_target(first_of_set(n.get("srcset")) or first_of_set(n.get("data-srcset")), base))
        elif n.tag == "a":
            href = n.get("href")
            url = link_target(href, base) if _MAY_BE_IMAGE.search(href) else ""
            if url and path_of(url).lower().endswith(IMAGE_ENDS):
                add(url, Image(0, url, alt=one_line(n.words())))
        elif n.tag == "noscript":
            below = [*below, parse(n.words())]
            # what is parsed anew comes before the element's own text, which holds no elements
            below.reverse()
        if n.attrs:
            for key in BACKGROUNDS:
                if value := trim(n.get(key)):
                    add(image_target(bare_css_url(value), base))
        stack.extend(reversed(below))
    return list(found.values())
