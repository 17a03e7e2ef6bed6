"""What a plan moves and reads."""

import contextlib
import io
import re


def nodes(df, name):
    """The parts of the formatted plan of nodes whose name begins with ``name``."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return [x for x in re.split(r"\n\n+", out.getvalue()) if re.match(rf"\(\d+\) {name}", x)]
