"""Column masks for personal data (H2-H5).

The catalog-side "is the caller in group X" test does not exist in open-source
Spark, so the caller's role is an explicit argument. Each mask returns the
clear value for a privileged role and the masked form otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): the privileged group and mask texts.
PRIVILEGED_ROLE = "ingenieria"
DOC_ID_MASK = "#########"
PHONE_MASK = "$$$$$$$$$"
EMAIL_MASK = "*****"
EMAIL_CLEAR_PREFIX = 2


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clear_for(role: str | None, clear: Column, masked: Column) -> Column:
    return clear if role == PRIVILEGED_ROLE else masked


def mask_name(col, role: str | None = None) -> Column:
    c = _c(col)
    return _clear_for(role, c, F.md5(c))


def mask_doc_id(col, role: str | None = None) -> Column:
    c = _c(col)
    return _clear_for(role, c, F.lit(DOC_ID_MASK))


def mask_email(col, role: str | None = None, reference_style: bool = False) -> Column:
    """First two characters, the mask, then the domain (text after the last ``@``).

    Text without ``@`` would be shown whole after the mask by the reference's
    formula; by default it is masked after its first two characters instead
    (``reference_style=True`` keeps the original formula).
    """
    c = _c(col)
    domain = F.substring_index(c, "@", -1)
    if not reference_style:
        domain = F.when(c.contains("@"), domain).otherwise(F.lit(""))
    masked = F.concat(F.left(c, F.lit(EMAIL_CLEAR_PREFIX)), F.lit(EMAIL_MASK), domain)
    return _clear_for(role, c, masked)


def mask_phone(col, role: str | None = None) -> Column:
    c = _c(col)
    return _clear_for(role, c, F.lit(PHONE_MASK))


MASKS_BY_KIND = {
    "name": mask_name,
    "national_id": mask_doc_id,
    "email": mask_email,
    "phone_number": mask_phone,
}
