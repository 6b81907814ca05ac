"""Readers and writers: recordings, header files, receiver logs, packet landing areas."""
