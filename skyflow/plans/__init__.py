"""Session settings and the join, ordering and staging patterns the operators share."""
