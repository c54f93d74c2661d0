import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cdrmill.schema import CDR_FIELDS_AND_WIDTHS  # noqa: E402
from cdrmill.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = get_session("local[4]", app="cdrmill-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cdrmill-wh-")})
    yield s
    s.stop()


def cdr_line(**fields) -> str:
    """One 418-character call record line; unnamed fields are blank."""
    return "".join(str(fields.get(n, "")).ljust(w)[:w] for n, w in CDR_FIELDS_AND_WIDTHS)


TRUNK = [("TG1", "t1", "ND1", "OPA", "POIA"), ("TG2", "t2", "ND2", "OPB", "POIB")]
NODE = [("ND1", "n1", "FR1"), ("ND2", "n2", "FR2")]
