"""Writers: files, databases and stream outputs."""
