"""A listing of pages in memory, in place of HTTP."""

from __future__ import annotations

import re

from tests.test_cards import CARD


def page(n: int, of: int = 3, ids: tuple[int, ...] | None = None) -> str:
    ids = ids if ids is not None else (n * 10, n * 10 + 1)
    return "".join(CARD.format(id=i) for i in ids) + f'<div class="pagination-text">Page {n} of {of} | Total Records {of * 2}</div>'


def listing(method, url, body, headers, timeout):
    if method == "POST":
        return 303, [("Set-Cookie", "ci_session=s1; path=/")], b""
    n = int(re.search(r"page=(\d+)", url)[1])
    return (200, [], page(n).encode()) if n <= 3 else (404, [], b"")


def broken(method, url, body, headers, timeout):
    return (404, [], b"") if "page=2" in url else listing(method, url, body, headers, timeout)
