"""boxloom: curation and evaluation of object-detection datasets on Spark."""
