"""A download helper for archive files; not part of any plan."""

from __future__ import annotations

import shutil
import time
import urllib.error
import urllib.request
from collections.abc import Callable


def download(url: str, target: str, retries: int = 2, pause: float = 20.0, sleep: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen) -> None:
    """Gets url into target, trying `retries` more times; a 503 answer waits, twice as long each time."""
    last: Exception | None = None
    for _ in range(retries + 1):
        try:
            with opener(url) as response, open(target, "wb") as out:
                shutil.copyfileobj(response, out)
            return
        except urllib.error.HTTPError as e:
            last = e
            if e.code == 503:
                sleep(pause)
                pause *= 2
        except OSError as e:
            last = e
            sleep(pause)
    raise OSError(f"can't download {url}") from last
