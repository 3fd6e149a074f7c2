"""folioframe: document-annotation analytics as DataFrame operators on Spark."""

from folioframe.operators.layout import auto_edges, geometry_order, overlay_boxes
from folioframe.operators.shredding import annotation_tables, shred
from folioframe.operators.validation import report, score, validate
from folioframe.session import drop_stored, local_session

__all__ = ["annotation_tables", "auto_edges", "drop_stored", "geometry_order", "local_session", "overlay_boxes", "report", "score", "shred", "validate"]
