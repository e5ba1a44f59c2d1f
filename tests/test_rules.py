"""Guards for the library-wide rules (lineage cuts, joins, query names)."""

import pathlib
import re

import __spark_entry__ as E

PKG = pathlib.Path(__file__).resolve().parent.parent / "entiscore"


def _code(path):
    # strip comments and docstring-like lines
    return "\n".join(l for l in path.read_text().splitlines() if not l.strip().startswith("#"))


def test_no_local_checkpoint_or_cross_join():
    for p in PKG.rglob("*.py"):
        src = _code(p)
        assert "localCheckpoint(" not in src, p
        assert "crossJoin(" not in src, p


def test_query_names():
    from entiscore.plans import catalogue
    for name in catalogue.queries():
        assert not name.startswith("pipeline") and not re.match(r"op\d+_", name), name
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_private_folder_off_a_local_master():
    from types import SimpleNamespace

    import pytest

    from entiscore.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_library_does_not_import_the_training_data_operators():
    for p in PKG.rglob("*.py"):
        if "llm" not in p.parts:
            assert "entiscore.llm" not in p.read_text(), p
