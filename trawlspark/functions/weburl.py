"""Resolve one link the way browsers do. Small helper for the Arrow batches of the page operators."""

from __future__ import annotations

import ipaddress
import re
from urllib.parse import quote, unquote, urljoin

_DEFAULT_PORT = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21"}
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):")
_PARTS = re.compile(r"//([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?", re.S)
_BAD_HOST = re.compile(r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]")
# Characters left alone in each part; everything else is percent-encoded as UTF-8.
_SAFE_PATH = "!$%&'()*+,-./:;=@[]\\^_|~"
_SAFE_QUERY = "!$%&()*+,-./:;=?@[]\\^_`{|}~"
_SAFE_FRAGMENT = "!#$%&'()*+,-./:;=?@[]\\^_{|}~"


def _host(text: str) -> str | None:
    if text.startswith("["):
        try:
            return f"[{ipaddress.IPv6Address(text[1:-1]).compressed}]" if text.endswith("]") else None
        except ValueError:
            return None
    name = unquote(text)
    try:
        name = (name if name.isascii() else name.encode("idna").decode()).lower()
    except UnicodeError:
        return None
    if not name or _BAD_HOST.search(name):
        return None
    if re.search(r"(?:^|\.)(?:\d+|0x[0-9a-f]*)\.?$", name):
        return _ipv4(name)
    return name


def _ipv4(name: str) -> str | None:
    numbers = []
    for part in name.rstrip(".").split("."):
        try:
            if part.startswith("0x"):
                numbers.append(int(part[2:] or "0", 16))
            else:
                numbers.append(int(part, 8 if len(part) > 1 and part[0] == "0" else 10))
        except ValueError:
            return None
    *head, last = numbers
    if len(numbers) > 4 or any(n > 255 for n in head) or last >= 256 ** (5 - len(numbers)):
        return None
    value = last + sum(n * 256 ** (3 - i) for i, n in enumerate(head))
    return str(ipaddress.IPv4Address(value))


def _path(path: str) -> str:
    kept: list[str] = []
    parts = path.split("/")[1:] if path.startswith("/") else path.split("/")
    for i, part in enumerate(parts):
        plain = re.sub("%2e", ".", part, flags=re.I)
        final = i == len(parts) - 1
        if plain in (".", ".."):
            if plain == ".." and kept:
                kept.pop()
            if final:
                kept.append("")
        else:
            kept.append(part)
    return "/" + "/".join(kept)


def absolute_url(text: str, base: str | None = None) -> str | None:
    """Normalised absolute URL of ``text``, read relative to ``base`` if given; None when it is no URL."""
    text = re.sub(r"[\t\n\r]", "", re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", text))
    scheme = _SCHEME.match(text)
    if scheme is None:
        if base is None or _SCHEME.match(base) is None:
            return None
        if base.split(":", 1)[0].lower() not in _DEFAULT_PORT:
            return None
        if not text:
            text = base.split("#", 1)[0]
        else:
            head, mark, tail = re.match(r"([^?#]*)([?#]?)(.*)", text, re.S).groups()
            try:
                text = urljoin(base, head.replace("\\", "/") + mark + tail)
            except ValueError:
                return None
        scheme = _SCHEME.match(text)
        if scheme is None:
            return None
    kind, rest = scheme.group(1).lower(), text[scheme.end():]
    if kind not in _DEFAULT_PORT:
        return f"{kind}:{quote(rest, safe=_SAFE_FRAGMENT + ' ')}"
    cut = re.search(r"[?#]", rest)
    cut = cut.start() if cut else len(rest)
    rest = "//" + rest[:cut].replace("\\", "/").lstrip("/") + rest[cut:]
    authority, path, query, fragment = _PARTS.fullmatch(rest).groups()
    user, at, where = authority.rpartition("@")
    address = re.fullmatch(r"(\[[^\]]*\]|[^:\[]*)(?::(\d*))?", where)
    if address is None:
        return None
    host, port = _host(address.group(1)), address.group(2)
    if host is None or (port and int(port) > 65535):
        return None
    port = str(int(port)) if port else ""
    url = f"{kind}://{quote(user, safe=':%!$&*+,-._~()') + at if user else ''}{host}"
    if port and port != _DEFAULT_PORT[kind]:
        url += f":{port}"
    url += quote(_path(path), safe=_SAFE_PATH)
    if query is not None:
        url += "?" + quote(query, safe=_SAFE_QUERY)
    if fragment is not None:
        url += "#" + quote(fragment, safe=_SAFE_FRAGMENT)
    return url


def page_links(base: str | None, hrefs) -> list[str]:
    """Links of one page in order, duplicates kept: fragments-only links and what is no URL are left out.

    A relative link that begins with "http" is read as an absolute URL only, and so is dropped.
    """
    found = []
    for href in hrefs:
        url = None
        if not href.startswith("http"):
            if href.startswith("#"):
                continue
            url = absolute_url(href, base)
        if url is None:
            url = absolute_url(href)
        if url is not None:
            found.append(url)
    return found
