"""A rule over a table that grows: its program for every micro-batch."""

from collections import ChainMap

from ..plans import run_over
from ..sources import Tables


def write_rule(rule, stream, table, settings, checkpoint, **trigger):
    """Run a rule over each micro-batch of ``stream``, which stands for the table it names.

    ``rule`` is a dict of its columns and run id, as for ``plans.run_rule``; other tables are
    those of the settings, as they are when a batch comes. A batch is a run of its own, with the
    batch's number behind the run id: its rows are stamped, saved and recorded in the ledger as
    those of any run. A batch that is tried again replaces its rows, and has one final row in
    the ledger if it succeeded before. A rule that fails for a batch has failed for that run,
    and the stream goes on.

    What a rule says of single rows it says of the whole table in the end. A rule that groups
    the stream, or compares its rows, sees a batch at a time.
    """

    def save(rows, batch_id):
        session = rows.sparkSession
        others = Tables(session, settings.data_config, settings.dictionary, settings.on_bad_value)
        of_batch = rule | {"rule_run_id": f"{rule['rule_run_id']}-{batch_id}"}
        run_over(session, of_batch, ChainMap({table: rows}, others), settings)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**trigger).start()
