"""Tables in and out: seeds, web table snapshots, XML dimensions, responses, index sink."""
