"""Object-URI and product-name functions: Column -> Column, all JVM-side.

"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL shapes of object storage that must be recognised exactly.
# Path style is tried first, then virtual-hosted style; regional hosts
# (``s3.us-west-2`` / ``s3-us-west-2``) and dotted bucket names are accepted.
PATH_STYLE = r"^https?://s3(?:[.-][a-z0-9-]+)?[.]amazonaws[.]com/([^/]+)/(.*)$"
VIRTUAL_STYLE = r"^https?://([a-z0-9.-]+?)[.]s3(?:[.-][a-z0-9-]+)?[.]amazonaws[.]com/(.*)$"
# The two narrow patterns of the original tool (strict mode reproduces them).
PATH_STYLE_STRICT = r"^https?://s3[.]amazonaws[.]com/([^/]+)/(.*)"
VIRTUAL_STYLE_STRICT = r"^https?://([^.]+)[.]s3[.]amazonaws[.]com/(.*)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- X1 / X7
def parse_object_uri(uri) -> Column:
    """``s3://bucket/key`` or host style ``s3://s3-region...:port/bucket/key``
    -> struct(bucket, key, error). A bad scheme gives NULL parts and an error."""
    u = _c(uri)
    rest = F.substring(u, 6, 1 << 30)
    host = F.substring_index(rest, "/", 1)
    host_style = ((rest.startswith("s3-") | rest.startswith("s3."))
                  & (host.contains("amazonaws") | host.rlike(":[0-9]+$")))
    has_slash = F.instr(rest, "/") > 0
    after_host = F.substring(rest, F.instr(rest, "/") + 1, 1 << 30)
    path = F.when(host_style, F.when(has_slash, after_host)).otherwise(rest)
    path_slash = F.instr(path, "/")
    bucket = F.substring_index(path, "/", 1)
    key = F.when(path_slash > 0, F.substring(path, path_slash + 1, 1 << 30)).otherwise(F.lit(""))
    ok_scheme = u.startswith("s3://")
    error = (F.when(~ok_scheme, F.lit("invalid scheme"))
             .when(host_style & ~has_slash, F.lit("missing bucket")))
    ok = error.isNull()
    return F.struct(F.when(ok, bucket).alias("bucket"), F.when(ok, key).alias("key"),
                    error.alias("error"))


def is_valid_object_uri(uri) -> Column:
    """Prefix ``s3://`` and longer than the prefix."""
    u = _c(uri)
    return u.startswith("s3://") & (F.length(u) > 5)


# ---------------------------------------------------------------- X2 / X3
def http_to_object_uri(link, strict: bool = False) -> Column:
    """Object-store HTTP(S) URL -> ``s3://bucket/key``; NULL when no match."""
    u = _c(link)
    p, v = (PATH_STYLE_STRICT, VIRTUAL_STYLE_STRICT) if strict else (PATH_STYLE, VIRTUAL_STYLE)
    return (F.when(u.rlike(p), F.concat(F.lit("s3://"), F.regexp_extract(u, p, 1), F.lit("/"),
                                        F.regexp_extract(u, p, 2)))
            .when(u.rlike(v), F.concat(F.lit("s3://"), F.regexp_extract(u, v, 1), F.lit("/"),
                                       F.regexp_extract(u, v, 2))))


def needs_conversion(href) -> Column:
    """The original tool's test - ``https://`` and contains ``.s3.``."""
    h = _c(href)
    return h.startswith("https://") & h.contains(".s3.")


def to_object_uri(href, strict: bool = False) -> Column:
    """Rewrite an asset href; keep the original when it is not an object URL.

    Default: any HTTP(S) object URL converts (both styles).  ``strict`` applies
    the X3 gate and the narrow patterns, and - like the original - yields NULL
    when the gate passes but no pattern matches."""
    h = _c(href)
    if strict:
        return F.when(needs_conversion(h), http_to_object_uri(h, strict=True)).otherwise(h)
    return F.coalesce(http_to_object_uri(h), h)


# ---------------------------------------------------------------- X4 / X5 / X6
def _remove_dot_segments(path: Column) -> Column:
    """Fold ``.`` and ``..`` segments of an absolute path (RFC 3986 5.2.4)."""
    segs = F.split(path, "/")
    # the first element is '' for an absolute path; keep it as the root
    folded = F.aggregate(
        F.slice(segs, 2, 1 << 30), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segs, -1)
    trailing = F.when((F.size(segs) > 1) & last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(folded, "/"), trailing)


def normalize_href(href, base) -> Column:
    """Make ``href`` absolute against ``base`` (http(s) or s3 URL).

    Absolute hrefs pass; ``bucket/...`` below an s3 base gains ``s3://``;
    everything else resolves like a browser: ``/x`` from the authority,
    ``x``/``./x``/``../x`` from the base's folder (query and fragment of the
    base dropped), with dot segments folded."""
    h, b = _c(href), _c(base)
    absolute = h.startswith("http://") | h.startswith("https://") | h.startswith("s3://")
    scheme_end = F.instr(b, "://")
    after_scheme = F.substring(b, scheme_end + 3, 1 << 30)
    authority = F.substring_index(after_scheme, "/", 1)
    origin = F.concat(F.substring(b, 1, scheme_end + 2), authority)
    base_path_q = F.substring(after_scheme, F.length(authority) + 1, 1 << 30)
    base_path = F.regexp_replace(base_path_q, r"[?#].*$", "")
    base_dir = F.regexp_replace(F.when(base_path == "", F.lit("/")).otherwise(base_path), "[^/]*$", "")
    href_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    href_tail = F.substring(h, F.length(href_path) + 1, 1 << 30)
    merged = F.when(h.startswith("/"), href_path).otherwise(F.concat(base_dir, href_path))
    resolved = F.concat(origin, _remove_dot_segments(merged), href_tail)
    bucket = F.substring_index(after_scheme, "/", 1)
    bucket_prefixed = b.startswith("s3://") & (bucket != "") & h.startswith(F.concat(bucket, F.lit("/")))
    return (F.when(h.isNull() | b.isNull(), h)
            .when(absolute, h)
            .when(bucket_prefixed, F.concat(F.lit("s3://"), h))
            .when(h == "", b)
            .otherwise(resolved))


def normalize_links(links, base) -> Column:
    """Every link's href made absolute."""
    return F.transform(_c(links), lambda l: l.withField("href", normalize_href(l["href"], base)))


def normalize_assets(assets, base) -> Column:
    """Every asset's href made absolute (map key -> struct with href)."""
    return F.transform_values(_c(assets), lambda k, a: a.withField("href", normalize_href(a["href"], base)))


# ---------------------------------------------------------------- X11 / X12
def prefix_rewrite(key, src_prefix: str, dst_prefix: str) -> Column:
    """X11: replace a leading ``src_prefix`` by ``dst_prefix``."""
    k = _c(key)
    return (F.when(k.startswith(src_prefix),
                   F.concat(F.lit(dst_prefix), F.substring(k, len(src_prefix) + 1, 1 << 30)))
            .otherwise(k))


def relative_key(key, prefix) -> Column:
    """Path of ``key`` below ``prefix`` (``.`` when equal)."""
    k = _c(key)
    p = F.regexp_replace(_c(prefix) if not isinstance(prefix, str) else F.lit(prefix), "/+$", "")
    rel = F.regexp_replace(F.substring(k, F.length(p) + 1, 1 << 30), "^/+", "")
    rel = F.regexp_replace(rel, "/+$", "")
    return F.when((p == "") | F.isnull(p), F.regexp_replace(k, "/+$", "")).when(rel == "", F.lit(".")).otherwise(rel)


# ---------------------------------------------------------------- X15 / X16 / X28
def file_stem(name) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(_c(name), r"^(.*?)([.][^.]*)?$", 1)


def file_ext(name) -> Column:
    return F.regexp_extract(_c(name), r"^(.*?)([.][^.]*)?$", 2)


def short_id(col, n: int) -> Column:
    """Last ``n`` characters (10 for granules/URIs, 7 for job ids)."""
    return F.right(_c(col), F.lit(n))


def product_names(name, variable, ts) -> dict[str, Column]:
    """The product file names derived from an input file name."""
    stem = file_stem(name)
    return {
        "zarr_name": F.concat(stem, F.lit(".zarr")),
        "tif_name": F.concat(stem, F.lit("_"), _c(variable), F.lit(".tif")),
        "pre_name": F.concat(stem, F.lit("_preprocessed.nc")),
        "concat_name": F.concat(F.lit("concat."), stem, F.lit(".zarr")),
        "ondemand_name": F.concat(F.lit("ondemand_"), F.date_format(_c(ts), "yyyyMMddHHmmss"),
                                  F.lit("_"), _c(name)),
    }


def variable_from_filename(name) -> Column:
    """Raster variable from a file name: trailing ``_UPPER`` token, then an
    inner ``_UPPER_`` token, then the last ``_`` token, else ``data``."""
    stem = file_stem(F.regexp_extract(_c(name), r"([^/]*)$", 1))
    t1 = F.regexp_extract(stem, r"_([A-Z][A-Z0-9]*)$", 1)
    t2 = F.regexp_extract(stem, r"_([A-Z]{2,})_", 1)
    t3 = F.regexp_extract(stem, r"_([^_]+)$", 1)
    return F.coalesce(F.nullif(t1, F.lit("")), F.nullif(t2, F.lit("")), F.nullif(t3, F.lit("")), F.lit("data"))


# ---------------------------------------------------------------- X25 / X26
def item_endpoint(host, collection_id, item_id) -> Column:
    """``{host}/stac/collections/{cid}/items/{iid}``."""
    return F.concat_ws("/", _c(host), F.lit("stac/collections"), _c(collection_id), F.lit("items"), _c(item_id))


# The feature-query URL, and the page size the original tool puts in it.
FEATURE_QUERY = "/ows?service=WFS&version=1.0.0&request=GetFeature&typeName="
FEATURE_FORMAT = "&outputFormat=application%2Fjson"
ORIGINAL_MAX_FEATURES = 10000


def feature_query_url(host, workspace, layer, max_features: int | None = None) -> Column:
    """WFS GetFeature URL for ``workspace:layer`` (layer name URL-encoded).
    By default it asks for every feature; ``max_features`` limits it."""
    limit = "" if max_features is None else f"&maxFeatures={int(max_features)}"
    return F.concat(_c(host), F.lit("/"), _c(workspace), F.lit(FEATURE_QUERY),
                    _c(workspace), F.lit("%3A"), F.url_encode(_c(layer)), F.lit(FEATURE_FORMAT + limit))
