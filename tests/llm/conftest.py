from __future__ import annotations

import sys
from pathlib import Path

for place in (Path(__file__).resolve().parent, Path(__file__).resolve().parents[2]):
    if str(place) not in sys.path:
        sys.path.insert(0, str(place))
