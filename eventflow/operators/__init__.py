"""Frame-to-frame operators (FLT-*, AGG-*, VER-*, MET-*)."""
