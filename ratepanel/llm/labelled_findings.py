"""Labelled findings: what stands around a value, the value's form, and whether it is a secret.

The forest of `secrets` learns from them where a corpus brings none of its own.
Each line is one way in which such a value is written; values are made from its
form, so that no real key is kept here. Some lines are held out of training, to
measure precision and recall on ways of writing that were not learned from.
"""

from __future__ import annotations

import random
import string
from collections.abc import Iterator
from dataclasses import dataclass

#: Values made for each line.
VALUES = 8
_HEX, _ALNUM = "0123456789abcdef", string.ascii_letters + string.digits
_BASE64 = _ALNUM + "+/"
_WORDS = "river stone market window garden summer copper basket letter yellow signal harbor ticket planet".split()


@dataclass(frozen=True)
class Line:
    secret: bool
    before: str
    form: str
    after: str
    path: str = "src/app"
    held: bool = False


def make(form: str, rnd: random.Random) -> str:
    """A value of a form: a kind and, for some, a length."""
    kind, _, size = form.partition(":")
    n = int(size or 0)
    draw = lambda letters, k: "".join(rnd.choice(letters) for _ in range(k))
    mixed = lambda letters, k: "".join(rnd.sample([rnd.choice("abcdef"), rnd.choice(string.digits), *draw(letters, k - 2)], k))
    word = lambda: rnd.choice(_WORDS)
    match kind:
        case "hex":
            return mixed(_HEX, n)
        case "alnum":
            return mixed(_ALNUM, n)
        case "base64":
            return mixed(_BASE64, n) + "="
        case "password":
            return mixed(_ALNUM + "!#%*+?^_~", n)
        case "simple":
            return mixed(string.ascii_lowercase, n - 2) + rnd.choice(["", "\\\"", "!", "#"]) + draw(string.digits, 2)
        case "digits":
            return rnd.choice("123456789") + draw(string.digits, n - 1)
        case "uuid":
            return "-".join(draw(_HEX, k) for k in (8, 4, 4, 4, 11)) + rnd.choice("0123456789")
        case "slug":
            return f"{word()}-{word()}-{rnd.randrange(1, 99)}-{word()}"
        case "host":
            return f"{word()}{rnd.randrange(1, 99)}.{word()}-{word()}.{rnd.choice(['com', 'org', 'net'])}"
        case "file":
            return f"{word()}/{word()}_{word()}/{word()}{rnd.randrange(1, 99)}.{rnd.choice(['py', 'txt', 'json'])}"
        case "version":
            return f"v{rnd.randrange(9)}.{rnd.randrange(30)}.{rnd.randrange(30)}-rc{rnd.randrange(9)}-build.{rnd.randrange(100, 999)}"
        case "time":
            return f"20{rnd.randrange(10, 30)}-0{rnd.randrange(1, 9)}-1{rnd.randrange(9)}T1{rnd.randrange(9)}:{rnd.randrange(10, 59)}:{rnd.randrange(10, 59)}Z"
        case "call":
            return f"{word()}_{word()}{rnd.randrange(1, 9)}({word()}"
        case "name":
            return f"{word()}_{word()}_{word()}_{rnd.randrange(1, 9)}"
        case "reference":
            return rnd.choice(["${%s_%s_%d}", "$%s_%s_value%d", "{{%s.%s.%d}}", "%%(%s_%s_%d)s"]) % (word().upper(), word().upper(), rnd.randrange(9))
        case "sample":
            end = rnd.choice(["00000", "12345678", "1234567890", "xxxx-1234", "here-1", "123456789abc"])
            return rnd.choice(["example-token-", "your_api_key_", "your-secret-", "changeme-", "dummy_value_", "test-key-", "placeholder-", "insert-key-", "sample_pass_"]) + end
        case "mask":
            return rnd.choice(["xxxxxxxx", "********", "00000000", "AAAAAAAA"]) * 2 + rnd.choice(["1234", "0000", "12345678"])
        case "aws":
            return "AKIA" + draw(string.ascii_uppercase * rnd.choice([1, 3]) + "234567", 15) + rnd.choice("234567")
        case "github":
            return "ghp_" + draw(rnd.choice([_ALNUM, string.digits * 3 + "abcdefABCDEF"]), 36)
        case "stripe":
            return rnd.choice(["sk_live_", "rk_live_"]) + draw(rnd.choice([_ALNUM, string.ascii_lowercase + string.digits]), rnd.choice([20, 24]))
        case "issued":
            return rnd.choice(["glpat-", "npm_", "hf_", "sk-", "pypi-"]) + draw(rnd.choice([_ALNUM, string.ascii_lowercase + string.digits]), 34)
        case "slack":
            return f"xoxb-{draw(string.digits, 11)}-{draw(_ALNUM, 24)}"
        case "jwt":
            return f"eyJ{draw(_ALNUM, 17)}.eyJ{draw(_ALNUM, 30)}.{draw(_ALNUM, 43)}"
        case "pem":
            return "\n" + "\n".join(draw(_BASE64, 64) for _ in range(n)) + "\n"
        case _:
            raise ValueError(f"no such form: {form}")


def _secrets() -> Iterator[Line]:
    yes = lambda *a, **k: Line(True, *a, **k)
    yield yes('token = "', "hex:40", '"')
    yield yes('token = "', "alnum:32", '"', "lib/client")
    yield yes("export API_TOKEN=", "hex:32", "\n", "deploy/env")
    yield yes("SECRET_KEY=", "alnum:50", "\nDEBUG=1", ".env")
    yield yes("export GITHUB_TOKEN=", "github", " now", "ci/run")
    yield yes("AWS_SECRET_ACCESS_KEY=", "base64:39", "", "infra/aws")
    yield yes("aws_access_key_id = ", "aws", "\n", "infra/aws")
    yield yes("https://h.example/x?token=", "hex:32", "&y=1", "docs/api")
    yield yes("?api_key=", "alnum:24", " HTTP/1.1", "logs/web")
    yield yes('password: "', "password:12", '"', "conf/db")
    yield yes("password=", "password:11", ";Database=x", "conf/db")
    yield yes('{"user":"a","pwd":"', "password:10", '"}', "web/login")
    yield yes('{"name":"b","pwd":"', "simple:10", '"}', "web/login")
    yield yes('password = "', "simple:9", '"', "conf/db")
    yield yes("the new key ", "stripe", " works", "chat/dev")
    yield yes("key: ", "aws", "\n", "conf/app")
    yield yes("pay by ", "stripe", " then", "mail/shop")
    yield yes("found ", "issued", " in it", "git/log")
    yield yes("login ", "issued", "\n", "ci/run")
    yield yes("x = '", "issued", "'", "src/main")
    yield yes("`", "github", "` was pushed", "chat/dev")
    yield yes("export GH_TOKEN=", "github", "\n", "ci/run")
    yield yes("(", "aws", ")", "wiki/a")
    yield yes("with ", "slack", " as the bot", "chat/ops")
    yield yes("cookie ", "jwt", "; path=/", "logs/web")
    yield yes('- "FOO_TOKEN=', "alnum:16", '"', "deploy/compose")
    yield yes("secret=", "base64:23", "\nnext", "a")
    yield yes("secret: ", "alnum:28", "\n", "helm/values")
    yield yes("the password is passwd: ", "password:9", " ok", "mail/inbox")
    yield yes("Authorization: Bearer ", "jwt", "", "logs/web")
    yield yes("curl -H 'Authorization: Basic ", "base64:24", "'", "docs/api")
    yield yes("our key is ", "aws", ", rotate it", "mail/inbox")
    yield yes("please use ", "github", " for now", "mail/inbox")
    yield yes("charge with ", "stripe", " only", "mail/inbox")
    yield yes("post as ", "slack", "\n", "chat/ops")
    yield yes("-----BEGIN RSA PRIVATE KEY-----", "pem:4", "-----END RSA PRIVATE KEY-----", "ssh/id")
    yield yes('TOKEN_V2: "', "hex:32", '"', "web/login")
    yield yes('secret_key_base = "', "hex:64", '"', "config/secrets")
    yield yes("accessTokenValue=", "hex:32", " end", "src/main")
    yield yes("db at postgres://user:", "password:10", "@host/db", "conf/db")
    yield yes('client_secret="', "alnum:30", '")', "tests/oauth")
    yield yes("token: '", "github", "'", "examples/ci")
    yield yes('"private_key" => "', "hex:64", '",', "wallet/a")
    yield yes('credential: "', "password:14", '"', "conf/ldap", held=True)
    yield yes("mysql://root:", "password:12", "@db:3306/x", "docker/run", held=True)
    yield yes('apiKey: "', "alnum:39", '",', "app/firebase", held=True)
    yield yes("DB_PASSWORD='", "password:13", "'", "deploy/env", held=True)
    yield yes("x-auth-token: ", "hex:40", "\r\n", "logs/http", held=True)
    yield yes("signing key = ", "base64:43", "\n", "conf/jwt", held=True)
    yield yes("send it with ", "jwt", " please", "chat/dev", held=True)
    yield yes("-----BEGIN EC PRIVATE KEY-----", "pem:2", "-----END EC PRIVATE KEY-----", "tls/a", held=True)
    yield yes("passphrase := '", "password:16", "'", "go/main", held=True)


def _others() -> Iterator[Line]:
    no = lambda *a, **k: Line(False, *a, **k)
    yield no("commit ", "hex:40", " done", "git/log")
    yield no("checksum: ", "hex:64", "\n", "release/a")
    yield no("sha256 token: ", "hex:64", "\n", "release/a")
    yield no('md5 = "', "hex:32", '"', "release/a")
    yield no("md5 password: ", "hex:32", "\n", "wiki/a")
    yield no('checksum key = "', "hex:40", '"', "conf/app")
    yield no('sha1_secret="', "hex:40", '"', "src/main")
    yield no("request id ", "uuid", " failed", "logs/web")
    yield no('"id": "', "uuid", '"', "api/items")
    yield no("call ", "digits:16", " now", "wiki/a")
    yield no("order number: ", "digits:12", ".", "mail/shop")
    yield no("card ", "digits:16", ", please", "mail/shop")
    yield no("by mail from ", "host", " today", "mail/inbox")
    yield no("see https://", "host", "/index", "wiki/a")
    yield no("open ", "file", " first", "wiki/a")
    yield no("path = ", "file", "\n", "conf/app")
    yield no("version: ", "version", "\n", "release/a")
    yield no("at ", "time", " it began", "logs/web")
    yield no("chapter ", "slug", " ends", "wiki/a")
    yield no("url: /", "slug", "\n", "web/menu")
    yield no("token = ", "call", ")", "src/main")
    yield no("password = ", "call", ")", "src/main")
    yield no("token = ", "name", "\n", "src/main")
    yield no("api_key=", "reference", "\n", "deploy/env")
    yield no('password: "', "reference", '"', "helm/values")
    yield no('token = "', "sample", '"', "docs/api")
    yield no("api_key=", "sample", "\n", ".env.sample")
    yield no('api_key="', "sample", '"', "src/main")
    yield no("secret: ", "mask", "\n", "conf/app")
    yield no('password = "', "mask", '"', "docs/api")
    yield no('"name": "', "slug", '"', "api/items")
    yield no('class="', "slug", '"', "web/page")
    yield no("title='", "name", "'", "web/page")
    yield no("x = '", "alnum:9", "'", "src/main")
    yield no("etag: ", "hex:32", "\r\n", "logs/http")
    yield no("build digest ", "hex:64", " pushed", "ci/run", held=True)
    yield no("invoice=", "digits:14", "&a", "mail/shop", held=True)
    yield no("iban: ", "digits:20", "\n", "mail/bank", held=True)
    yield no('secret="', "sample", '"', "src/app", held=True)
    yield no("auth_token: ", "reference", "\n", "ci/run", held=True)
    yield no("credentials = ", "call", ")", "src/login", held=True)
    yield no("trace=", "uuid", ";", "logs/web", held=True)
    yield no("import ", "file", "\n", "src/app", held=True)
    yield no('client_secret = "', "mask", '"', "docs/oauth", held=True)
    yield no("updated: ", "time", "\n", "wiki/a", held=True)


def findings(held: bool) -> list[tuple[int, str, str, str, str, int]]:
    """Number, text before, value, text after, path and label (1 a secret), of the lines held out or of the others."""
    out = []
    for at, line in enumerate([*_secrets(), *_others()]):
        if line.held == held:
            rnd = random.Random(at)
            out += [(at * VALUES + i, line.before, make(line.form, rnd), line.after, line.path, int(line.secret)) for i in range(VALUES)]
    return out
