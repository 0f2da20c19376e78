import gzip
import time
from email.utils import formatdate

import pytest

from tidewire.errors import ApiError, EngineError, clean_errors, redact, redact_url
from tidewire.operators.joins import segment
from tidewire.sources import paging
from tidewire.sources.config import Auth, Http, Pagination
from tidewire.sources.http import Client, RateLimiter


def client(api, sleeps=None, auth=Auth(), **settings):
    waits = [] if sleeps is None else sleeps
    return Client(Http(**settings), auth, api.url, sleep=waits.append)


def ids(pages):
    return [r["id"] for p in pages for r in p.records]


@pytest.mark.parametrize(
    ("auth", "header", "value"),
    [
        (Auth(), "Authorization", None),
        (Auth("bearer", token="t"), "Authorization", "Bearer t"),
        (Auth("basic", username="u", password="p"), "Authorization", "Basic dTpw"),
        (Auth("header", header_name="X-Key", header_value="k"), "X-Key", "k"),
    ],
)
def test_credentials(api, auth, header, value):
    api.routes["/x"] = lambda q, h, b: {"got": h.get(header)}
    got = client(api, auth=auth)
    assert paging._json(got.get(got.url("/x", {})).body, "") == {"got": value}


def test_oauth_refreshes_once_on_401(api):
    given = []
    api.routes["/token"] = lambda q, h, b: (given.append(b), {"access_token": f"t{len(given)}", "expires_in": 3600})[1]
    api.routes["/x"] = lambda q, h, b: [1] if h["Authorization"] == "Bearer t2" else (401, {}, "no")
    c = client(api, auth=Auth("oauth2", client_id="i", client_secret="s", token_url=api.url + "/token"))
    assert c.get(c.url("/x", {})).body == b"[1]"
    assert len(given) == 2 and b"client_credentials" in given[0]
    api.routes["/x"] = (401, {}, "no")
    with pytest.raises(ApiError, match="401"):
        c.get(c.url("/x", {}))
    assert len(api.requests("/x")) == 4


def test_oauth_refreshes_before_the_end(api):
    given = []
    api.routes["/token"] = lambda q, h, b: (given.append(1), {"access_token": "t", "expires_in": 30})[1]
    api.routes["/x"] = []
    c = client(api, auth=Auth("oauth2", client_id="i", client_secret="s", token_url=api.url + "/token"))
    c.get(c.url("/x", {}))
    c.get(c.url("/x", {}))
    assert len(given) == 2


def test_retries_and_backoff(api):
    answers = [(500, {}, "x"), (429, {"Retry-After": "7"}, "x"), (503, {"Retry-After": formatdate(time.time() + 90, usegmt=True)}, "x"), (502, {"Retry-After": "rubbish"}, "x"), [1]]
    api.routes["/x"] = lambda q, h, b: answers.pop(0)
    waits = []
    assert client(api, waits, max_backoff=4).get(api.url + "/x").body == b"[1]"
    assert waits[0] == 1 and waits[1] == 7 and 80 < waits[2] <= 91 and waits[3] == 4


@pytest.mark.parametrize(("status", "requests"), [(500, 4), (429, 4), (404, 1), (400, 1)])
def test_request_counts(api, status, requests):
    api.routes["/x"] = (status, {"X-Request-Id": "r-1"}, '{"error": "no", "token": "abcdef123456"}')
    with pytest.raises(ApiError) as caught:
        client(api, max_retries=3).get(api.url + "/x?api_key=hush&n=1")
    assert len(api.requests()) == requests
    text = str(caught.value)
    assert str(status) in text and "r-1" in text and "hush" not in text and "abcdef" not in text


def test_unreachable():
    waits = []
    with pytest.raises(EngineError, match="failed"):
        Client(Http(max_retries=2, timeout=2), sleep=waits.append).get("http://127.0.0.1:9/x")
    assert waits == [1, 2]


def test_rate_limit_spacing():
    now, waits = [0.0], []
    limiter = RateLimiter(4, clock=lambda: now[0], sleep=waits.append)
    for _ in range(3):
        limiter.take()
    assert waits == [0.25, 0.5]


def test_compression(api):
    api.routes["/x"] = lambda q, h, b: (200, {"Content-Encoding": "gzip"}, gzip.compress(b"[1]")) if "gzip" in h["Accept-Encoding"] else [2]
    assert client(api).get(api.url + "/x").body == b"[1]"
    assert client(api, compression=False).get(api.url + "/x").body == b"[2]"


def test_response_cache(api):
    api.routes["/x"] = [1]
    api.routes["/bad"] = (404, {}, "")
    c = client(api, cache=True, cache_ttl=61.5)
    for q in ("?a=1&b=2", "?b=2&a=1", "?a=1&b=3"):
        c.get(api.url + "/x" + q)
    assert len(api.requests("/x")) == 2
    for _ in range(2):
        with pytest.raises(ApiError):
            c.get(api.url + "/bad")
    assert len(api.requests("/bad")) == 2
    client(api, cache=True, cache_ttl=61.5, auth=Auth("bearer", token="other")).get(api.url + "/x?a=1&b=2")
    assert len(api.requests("/x")) == 3


def test_redaction():
    assert "ghp_" not in redact("key ghp_abcdefghijklmnop") and "[SCRUBBED]" in redact("Authorization: Bearer abcdefghijkl")
    assert redact_url("http://x/y?access_token=a&page=2") == "http://x/y?access_token=[REDACTED]&page=2"
    for name in ("key", "access_key", "pass", "passwd", "api-key", "X-Signature", "client_secret", "session_id", "auth"):
        assert redact_url(f"http://x/y?a=1&{name}=hush&b=2") == f"http://x/y?a=1&{name}=[REDACTED]&b=2"
    for text in ('{"private_key": "hush"}', "pass=hush&a=1", "api_key: hush", '"refreshToken":"hush"'):
        assert "hush" not in redact(text) and "[SCRUBBED]" in redact(text)
    assert redact("page=2 monkey business keys: none") == "page=2 monkey business keys: none"
    with pytest.raises(EngineError, match="boom"), clean_errors():
        raise ValueError("boom\n  at somewhere")


def test_no_paging(api):
    api.routes["/x"] = {"items": [{"id": 1}]}
    assert ids(paging.pages(client(api), "/x", {"a": "b c"}, Pagination(), "/items")) == [1]
    assert api.log == ["/x?a=b%20c"]


CURSOR = Pagination("cursor", cursor_path="/next", page_size_param="n", max_page_size=2)


def test_cursor(api):
    api.routes["/e"] = lambda q, h, b: {"next": "c2", "items": [{"id": 1}]} if "cursor" not in q else {"next": "", "items": [{"id": 2}]}
    got = list(paging.pages(client(api), "/e", {}, CURSOR, "/items"))
    assert ids(got) == [1, 2] and [p.state for p in got] == ["c2", "c2"]
    assert api.log == ["/e?n=2", "/e?n=2&cursor=c2"]
    assert ids(paging.pages(client(api), "/e", {}, CURSOR, "/items", start="c2")) == [2]
    api.clear()
    assert ids(paging.pages(client(api), "/e", {}, CURSOR, "/items", limit=1)) == [1]
    assert api.log == ["/e?n=1"]
    api.routes["/e"] = lambda q, h, b: {"next": "same", "items": []}
    assert len(list(paging.pages(client(api), "/e", {}, Pagination("cursor", cursor_path="/next", max_pages=4), "/items"))) == 4


def test_a_read_that_ends_at_max_pages_is_logged(api, caplog):
    api.routes["/e"] = lambda q, h, b: {"next": "same", "items": []}
    api.routes["/l"] = lambda q, h, b: (200, {"Link": '</l>; rel="next"'}, [{"id": 1}])
    api.routes["/i"] = rows(5)
    for path, paged, data in (("/e", Pagination("cursor", cursor_path="/next", max_pages=2), "/items"), ("/l", Pagination("link_header", max_pages=2), None), ("/i", Pagination("offset", page_size_param="limit", max_page_size=2, max_pages=2, results_path="/results"), "/results")):
        caplog.clear()
        assert len(list(paging.pages(client(api), path, {}, paged, data))) == 2
        assert f"{path}: the read ended at max-pages (2)" in caplog.text
    caplog.clear()
    assert ids(paging.pages(client(api), "/i", {}, OFFSET, "/results")) == list(range(5)) and not caplog.text


def rows(total, cap=10**9, ignore=False):
    def answer(q, h, b):
        lo = int(q.get("offset", 0))
        n = 100 if ignore else min(int(q.get("limit", 100)), cap)
        return {"results": [{"id": i} for i in range(lo, min(total, lo + n))]}

    return answer


OFFSET = Pagination("offset", page_size_param="limit", max_page_size=100, results_path="/results")


@pytest.mark.parametrize(("cap", "ignore"), [(10**9, False), (50, False), (10**9, True)])
def test_offset_windows(api, cap, ignore):
    api.routes["/i"] = rows(300, cap, ignore)
    got = [ids(paging.pages(client(api), "/i", {}, OFFSET, "/results", window=(a, a + 150))) for a in (0, 150)]
    assert got[0] + got[1] == list(range(300))


def test_offset(api):
    api.routes["/i"] = rows(250)
    got = list(paging.pages(client(api), "/i", {}, OFFSET, "/results"))
    assert ids(got) == list(range(250)) and got[-1].state == "250"
    assert ids(paging.pages(client(api), "/i", {}, OFFSET, "/results", start="240")) == list(range(240, 250))
    assert ids(paging.pages(client(api), "/i", {"offset": "-5"}, OFFSET, "/results", limit=3)) == [0, 1, 2]
    assert "limit=3" in api.log[-1]
    api.routes["/i"] = {"other": []}
    assert list(paging.pages(client(api), "/i", {}, OFFSET, "/results")) == []
    api.routes["/i"] = {"id": 1}
    api.clear()
    assert len(list(paging.pages(client(api), "/i", {}, Pagination("offset", max_pages=3), None))) == 3
    assert api.log == ["/i?offset=0", "/i?offset=100", "/i?offset=200"]


def test_links(api):
    api.routes["/l"] = lambda q, h, b: (200, {"Link": '</l?page=2>; rel="next", </l>; rel="first"'}, [{"id": 1}]) if "page" not in q else (200, {}, [{"id": 2}])
    paged = Pagination("link_header", page_size_param="per_page")
    assert ids(paging.pages(client(api), "/l", {"q": "x"}, paged, None)) == [1, 2]
    assert api.log == ["/l?q=x&per_page=100", "/l?page=2"]
    api.routes["/l"] = (200, {"Link": '<http://elsewhere.invalid/l>; rel="next"'}, [])
    with pytest.raises(EngineError, match="another origin"):
        list(paging.pages(client(api, auth=Auth("bearer", token="t")), "/l", {}, paged, None))


def test_streaming_formats(api):
    api.routes["/n"] = (200, {"Content-Type": "application/x-ndjson"}, '{"id": 1}\n\n{"id": 2}\r\n{"id": 3}')
    c = client(api, response_format="ndjson")
    assert ids(paging.fetch(c, "/n", {}, OFFSET, "/results")) == [1, 2, 3]
    assert ids(paging.fetch(c, "/n", {}, OFFSET, None, limit=2)) == [1, 2] and "offset" not in api.log[-1]
    api.routes["/n"] = '{"id": 1}\nrubbish\n'
    with pytest.raises(EngineError, match="line 2"):
        list(paging.fetch(c, "/n", {}, OFFSET, None))
    api.routes["/s"] = ': hi\nevent: x\ndata: {"id":\ndata: 1}\n\nid: 5\n\ndata:{"id": 2}\nretry: 3\n\ndata: {"id": 3}'
    assert ids(paging.fetch(client(api, response_format="sse"), "/s", {}, OFFSET, None)) == [1, 2, 3]


def test_path_segments():
    assert [segment(k) for k in ("x#y", "p?admin=1", "a b", "a/b", "..", "plain")] == ["x%23y", "p%3Fadmin%3D1", "a%20b", "a%2Fb", "%2E%2E", "plain"]


def test_reading_ahead_stops():
    seen = []

    def endless():
        i = 0
        while True:
            seen.append(i)
            yield i
            i += 1

    items = paging.ahead(endless(), 2)
    assert [next(items), next(items)] == [0, 1]
    items.close()
    time.sleep(0.3)
    n = len(seen)
    time.sleep(0.3)
    assert len(seen) == n < 20

    def broken():
        yield 1
        raise EngineError("later")

    with pytest.raises(EngineError, match="later"):
        list(paging.ahead(broken(), 2))
