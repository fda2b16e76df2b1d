"""The three jobs: sessions, areas and ad clicks."""
