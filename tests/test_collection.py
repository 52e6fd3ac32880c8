"""The tests are collected from one command."""

import os
import re
from collections import Counter

HERE = os.path.dirname(os.path.abspath(__file__))


def _modules():
    for folder, _, names in os.walk(HERE):
        for name in names:
            if name.endswith(".py"):
                yield folder, name


def test_no_two_test_modules_share_a_name():
    names = Counter(name for _, name in _modules() if name != "conftest.py")
    assert [n for n, k in names.items() if k > 1] == []


def test_nothing_is_imported_from_a_conftest():
    for folder, name in _modules():
        with open(os.path.join(folder, name)) as f:
            assert not re.search(r"^\s*(from|import) conftest\b", f.read(), re.M), name
