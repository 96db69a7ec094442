"""Ignore lists and run settings."""

from __future__ import annotations

import os
from dataclasses import dataclass

# File extensions, domain endings, registrable domains and query beginnings that links are dropped for.
IGNORED_EXTENSIONS = tuple(dict.fromkeys("""
.ai .bmp .css .csv .doc .gif .ico .jpeg .jpg .js .pdf .png .ppsx .ps .psd .svg .tif .tiff .txt .xls .xml
.3g2 .3gp .avi .flv .h264 .m4v .mkv .mov .mp4 .mpg .mpeg .rm .swf .vob .wmv
.aif .cda .mid .midi .mp3 .mpa .ogg .wav .wma .wpl
.doc .docx .odt .pdf .rtf .tex .txt .wks .wps .wpd .xml .ods .xlr .xls .xlsx
.7z .arj .deb .pkg .rar .rpm .gz .z .zip
""".split()))  # fmt: skip
IGNORED_ENDINGS = (".cn", ".blogspot.com")
IGNORED_DOMAINS = tuple("""
25418088.com.tw addtoany.com addthis.com adf.ly adobe.com aliexpress.com akismet.com amazon.com amazon.co.jp amazon.de
amazon.es amazon.fr amazon.in amazon.it amazonaws.com amzn.to apple.com baidu.com bbc.co.uk bit.ly blogger.com
blogspot.ca blogspot.com blogspot.de blogspot.fi blogspot.gr blogspot.co.id blogspot.jp blogspot.mx blogs.com
cdn.shopify.com clickbank.net cnn.com creativecommons.org deloplen.com doi.org dx.doi.org ebay.com ec.europa.eu
en.wikipedia.org eur-lex.europa.eu europa.eu facebook.com feedburner.com feedburner.google.com feeds.feedburner.com
flickr.com foundation.wikimedia.org fr.wikipedia.org gettyimages.com github.com goo.gl goodreads.com google.co.jp
google.co.uk google.com google.com.au google.com.br google.com.tr google.de google.ca google.es google.fr google.ru
google.ae google.at google.be google.bg google.by google.ch google.cl google.co.cr google.co.id google.co.il
google.co.in google.co.ke google.co.kr google.co.ma google.co.nz google.co.th google.co.ug google.co.ve google.com.ar
google.com.co google.com.cu google.com.do google.com.ec google.com.gt google.com.hk google.com.mx google.com.my
google.com.ng google.com.pe google.com.ph google.com.pk google.com.pr google.com.py google.com.sa google.com.sg
google.com.tw google.com.ua google.com.uy google.cz google.dk google.ee google.fi google.gr google.hr google.hu
google.ie google.is google.it google.lk google.lt google.lu google.lv google.nl google.no google.pl google.ps google.pt
google.ro google.se google.si google.sk google.tn googleusercontent.com gravatar.com hatena.ne.jp instagram.com
itunes.apple.com line.me linkedin.com liveinternet.ru maps.google.com maps.google.de maps.google.fr mediawiki.org
ncbi.nlm.nih.gov naver.com netflix.com overcast.fm paypal.com photobucket.com picasaweb.google.com pinterest.com
play.google.com policies.google.com pubads.g.doubleclick.net reddit.com rss.cnn.com scholar.google.co.uk
scholar.google.com search.google.com servimg.com shopify.com sitelist.icu statcounter.com stackoverflow.com
support.google.com t.co t.me telegram.me tradetracker.net translate.google.com tumblr.com twitter.com twss.de vimeo.com
vk.com whatsapp.com wikipedia.org wordpress.com wordpress.org yandex.ru youtu.be youtube.com ziprecruiter.com
""".split())
IGNORED_QUERIES = ("lang", "utm_", "ref")
#: The longest query, in bytes, that a page or link may have.
MAX_QUERY_BYTES = 200


def _number(name: str, low: int, high: int, default: int) -> int:
    try:
        value = int(os.environ.get(name, default))
    except ValueError:
        return default
    return value if low <= value <= high else default


@dataclass(frozen=True)
class EngineConfig:
    """Settings of a run; values out of range fall back to the defaults."""

    max_threads: int = 1  # of a local session that `session` makes
    max_wat_files: int = 1  # that a run of a segment imports
    data_path: str = "data"

    @classmethod
    def from_env(cls) -> EngineConfig:
        return cls(_number("LINKLOOM_THREADS", 1, 16, 1), _number("LINKLOOM_WAT_FILES", 1, 100_000, 1), os.environ.get("LINKLOOM_DATA") or "data")

    def session(self):
        """The running Spark session, or a local one with `max_threads` threads."""
        from pyspark.sql import SparkSession

        return SparkSession.getActiveSession() or SparkSession.builder.master(f"local[{self.max_threads}]").getOrCreate()

    def folders(self) -> dict[str, str]:
        return {name: f"{self.data_path}/{name}" for name in ("tmp", "links", "pages", "store", "log")}
