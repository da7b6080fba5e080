import re

from riskloom.llm import secrets

KEY = "aB3dE5gH7jK9mN1pQ3rT"


def _novel(text):
    return [text[a:b] for _, a, b, _ in secrets.novel_spans(text, secrets.base_spans(text))]


def test_names_with_prefixes_and_changes_of_case():
    for text in ('aws_secret_access_key = "{}"', "STRIPE_KEY={}", "db_pwd: {}", 'privateKey: "{}"', "sessionKey {}",
                 "encryption_key={}", "AWSKey: {}", "my-key: {}", "export STRIPE_LIVE_KEY={}"):
        assert _novel(text.format(KEY)) == [KEY], text
    assert not _novel(f"monkey {KEY}") and not _novel(f"keyboard: {KEY}") and not _novel(f"authored {KEY}")


def test_every_long_string_behind_a_word():
    assert _novel(f"key of internationalization_service {KEY}") == [KEY]
    other = "Zx8Yw6Vu4Ts2Rq0Po9Nm"
    assert _novel(f"token list {KEY} {other}") == [KEY, other]
    assert not _novel("key\n" + KEY) and not _novel("key " + "a " * 30 + KEY)


def test_candidates_of_the_old_search_stay(texts):
    old = re.compile(
        r"(?ai:\b(?:auth(?:orization)?|bearer|credentials?|private|access|api|signing|master|account|"
        r"client|session|cookie|salt|pwd|passphrase|password|passwd|secret|token|key)(?![a-z]))"
        r"[^\n]{0,40}?(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{16,})")
    for text in texts.values():
        assert {m.end(1) for m in old.finditer(text)} <= {end for _, end in secrets.candidates(text)}
    secrets.candidates("key=" * 50_000)
