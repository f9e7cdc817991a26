"""Plain versions of the operators, one row at a time, to compare with."""

import base64
import hashlib
import re

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def pii_row(text):
    spans = base_spans(text)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = [sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone")]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest())


def warc_rows(pages):
    """pages: (page_id, html) pairs with distinct ids."""
    best = {}
    for page_id, html in pages:
        best[html or ""] = max(best.get(html or "", page_id), page_id)
    out = []
    for page_id, html in pages:
        body = (html or "").encode()
        keeper = best[html or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        kind = "response" if keeper == page_id else "revisit"
        out.append((page_id, len(body), digest, kind, None if keeper == page_id else keeper))
    return sorted(out, key=str)
