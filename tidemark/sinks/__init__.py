"""Writers: slots, unloads, JDBC loads, log shreds, retention."""
